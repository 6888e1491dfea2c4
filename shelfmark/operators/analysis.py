"""Term index over product text: postings, term statistics and relevance weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import text as tx

NAME, DESCRIPTION, EDGE = "name", "description", "name.edge"
K1, B = 1.2, 0.75


def field_tokens(docs: DataFrame, fields: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
    """One row per (document, field) with its token array, reading the documents once."""
    arrays = F.array(
        *[F.struct(F.lit(name).alias("field"), tokens.alias("tokens")) for name, tokens in fields.items()]
    )
    return docs.select("id", *(keep or []), F.inline(arrays))


def standard_fields(products: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return field_tokens(
        products,
        {
            NAME: tx.standard_tokens(F.col("name")),
            DESCRIPTION: tx.standard_tokens(F.col("description")),
        },
        keep,
    )


def postings(tokens: DataFrame) -> DataFrame:
    """(field, term, id, tf, positions): positions are zero-based and ascending."""
    spread = tokens.select("field", "id", F.posexplode("tokens").alias("position", "term"))
    return spread.groupBy("field", "term", "id").agg(
        F.count("*").alias("tf"), F.array_sort(F.collect_list("position")).alias("positions")
    )


def term_frequencies(tokens: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(field, term, id, tf, dl, kept columns) without positions; dl is the field length in tokens."""
    keep = keep or []
    spread = tokens.select("field", "id", *keep, F.size("tokens").alias("dl"), F.explode("tokens").alias("term"))
    return spread.groupBy("field", "term", "id").agg(
        F.count("*").alias("tf"), F.first("dl").alias("dl"), *[F.first(c).alias(c) for c in keep]
    )


def term_stats(frequencies: DataFrame) -> DataFrame:
    """(field, term, df, cf)."""
    return frequencies.groupBy("field", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def field_stats(tokens: DataFrame) -> DataFrame:
    """(field, n_docs, avg_len), one row per field, over documents that have the field at all."""
    has_terms = F.size("tokens") > 0
    return tokens.filter(has_terms).groupBy("field").agg(
        F.count("*").alias("n_docs"), F.avg(F.size("tokens")).alias("avg_len")
    )


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def term_weight(tf: Column, dl: Column, avg_len: Column) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / avg_len))
