"""From raw documents to packed training sequences.

Each stage takes what its predecessor kept, as written down, and its decisions take effect: rejected documents go, of near
copies one stays, repeated passages and secrets are cut from the texts, and what remains is packed. All but the last
return the columns of `documents`, `n_chars` counted anew where a text has changed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import packing, repeats, resampling, secrets, simhash
from shelfmark.llm.common import table
from shelfmark.session import scratch, settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _like(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """Rows of (row, text) as columns of `docs`."""
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return changed.select(*[columns[c].alias(c) for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that op8's models of `labels` keep; null and empty texts are judged like others."""
    return resampling.keep(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of op3, by its shingles and distance, the row with the smallest doc_id; rows without a doc_id stay."""
    return simhash.one_of_each(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, its text without what repeats over 200 bytes and more; a null text becomes empty."""
    cut = repeats.remove_repeats(docs, as_text=True)
    return _like(docs, cut.select("row", F.col("kept").alias("text")))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, each reported span of its text masked; a null text becomes empty."""
    return _like(docs, secrets.mask(docs))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences: doc_id, source, start, length, doc_tokens, sequence_id, offset, ids."""
    cut = packing.pieces(docs.select("doc_id", "text", "source")).select("row.doc_id", "row.source", "*").drop("row")
    return packing.arranged(cut).drop("queue", "queued")


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("secret_scans", secret_scans),
    ("packing", sequence_packing),
]

#: No stage has a form in SQL; the tests hold each against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage writes for itself is removed once its result is written."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with scratch(spark):
            docs = settle(stage(spark, docs, sf_dir), keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
