"""The operators of this subpackage as named queries: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import bpe, contamination, licenses, order_minhash, packing, prefix_trie, quality_rules, repeats, resampling, secrets, simhash, urls, vector_codes
from shelfmark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("print")


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(table(spark, sf_dir, "documents"))


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(table(spark, sf_dir, "documents"))


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(table(spark, sf_dir, "documents"))


@query
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.round(c, 6) for c in ("js_chars", "js_words")})


@query
def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compare_with_edits(table(spark, sf_dir, "documents"))


@query
def op8_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


@query
def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


@query
def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(table(spark, sf_dir, "embeddings"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.report(table(spark, sf_dir, "conversations"))
