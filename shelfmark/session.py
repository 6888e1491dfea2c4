"""Session set-up and the shared folder used for checkpoints and written tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from shelfmark.sources.versions import delete


def local_session(app: str, cores: str = "8") -> SparkSession:
    """A session for tests and the benchmark. On a cluster the submitter configures the session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SHELFMARK_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in spark.checkpoint.dir.

    Only a session without that setting (a local test) gets a temporary folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="shelfmark-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing is created or deleted."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: The steps of the innermost `scratch`. A context variable, so that threads with pipelines of their own keep theirs apart.
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the steps that `settle` writes inside, once the results that read them have been written themselves."""
    written: list[str] = []
    outer = _scope.set(written)
    try:
        yield
    finally:
        _scope.reset(outer)
        for path in written:
            delete(spark, path)


def settle(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write an intermediate result to the shared folder and continue from the written table.

    Later steps neither recompute nor re-plan it, a lost executor costs a re-read only, and the planner knows
    its true size when it decides whether to broadcast it. Inside `scratch` it is removed at the end, unless kept.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "step")
    written = _scope.get()
    if written is not None and not keep:
        written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
