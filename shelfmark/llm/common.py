"""Helpers shared by the operators: tables, Python on the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shelfmark.llm.components import components
from shelfmark.operators.skew import running

__all__ = ["Batches", "components", "on_executors", "running", "table", "texts"]

ROOT = str(Path(__file__).resolve().parents[2])
Batches = Iterator[pa.RecordBatch]
#: Bytes of rows that Spark hands to Python at a time: fewer than its default of 64 MB, unless the session sets another.
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_DEFAULT, BATCH_BYTES = "67108864b", "4m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def on_executors(df: DataFrame, function: Callable[[Batches], Batches], schema: str | StructType) -> DataFrame:
    """mapInArrow in small batches. With a local master the workers are told where this package lies; on a cluster it is
    shipped."""
    spark = df.sparkSession
    context = spark.sparkContext
    if spark.conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    if context.master.startswith("local"):
        context.environment.setdefault("PYTHONPATH", ROOT)
    return df.mapInArrow(function, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """A text column as UTF-8 bytes."""
    return batch.column(name).cast(pa.large_binary()).to_pylist()
