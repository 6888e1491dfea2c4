"""Spell correction of search requests against the words of cleaned product names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import text as tx
from shelfmark.operators import skew
from shelfmark.operators.fuzzy import fuzzy_join, similarity
from shelfmark.session import settle

# Limits of spell suggestions.
MIN_LENGTH = 4
MAX_EDITS = 2
MIN_SIMILARITY = 0.5
MAX_SUGGESTIONS = 3


def words_of() -> Column:
    """The distinct words of a product's cleaned name."""
    return F.array_distinct(tx.standard_tokens(tx.clean_name(F.col("name"))))


def vocabulary(products: DataFrame) -> DataFrame:
    """(term, df) over the words of cleaned names."""
    return products.select(F.explode(words_of()).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def suggest(queries: DataFrame, words: DataFrame) -> DataFrame:
    """(query, position, suggestion): more frequent words near the first token of each distinct query."""
    token = F.get(tx.standard_tokens(F.col("query")), 0)
    first = settle(queries.select("query").distinct().select("query", token.alias("token")))
    tokens = first.filter(F.length("token") >= MIN_LENGTH).select("token").distinct()
    own = words.select(F.col("term").alias("token"), F.col("df").alias("own_df"))
    asked = tokens.join(own, "token", "left").withColumn("own_df", F.coalesce("own_df", F.lit(0)))
    near = fuzzy_join(tokens.withColumn("edits", F.lit(MAX_EDITS)), words, same_first_letter=True, budgets=(MAX_EDITS,))
    scored = (
        near.filter(F.col("distance") > 0)
        .join(asked, "token")
        .join(words, "term")
        .withColumn("similarity", similarity(F.col("distance"), F.col("token"), F.col("term")))
        .filter((F.col("df") > F.col("own_df")) & (F.col("similarity") >= MIN_SIMILARITY))
    )
    order = [F.desc("similarity"), F.desc("df"), F.col("term")]
    best = skew.top_k(scored, ["token"], order, MAX_SUGGESTIONS, ["term"], rank="position")
    options = skew.join(first, best.select("token", "position", "term"), ["token"])
    return options.filter(F.col("term") != F.lower("query")).select(
        "query", "position", F.col("term").alias("suggestion")
    )


def correct(requests: DataFrame, words: DataFrame) -> DataFrame:
    """Add `suggestions` and `corrected`; the first suggestion replaces the whole query."""
    asked = requests.filter(~tx.is_blank(F.col("query")))
    found = (
        suggest(asked, words)
        .groupBy("query")
        .agg(F.array_sort(F.collect_list(F.struct("position", "suggestion"))).alias("_found"))
        .select("query", F.col("_found.suggestion").alias("suggestions"))
    )
    none = F.array().cast("array<string>")
    return skew.join(requests, found, ["query"], "left").withColumns(
        {
            "suggestions": F.coalesce("suggestions", none),
            "corrected": F.when(
                ~tx.is_blank(F.col("query")), F.coalesce(F.get("suggestions", F.lit(0)), F.col("query"))
            ),
        }
    )


def catalog_vocabulary(products: DataFrame, rows: int = 100, terms: int = 15) -> DataFrame:
    """(position, term): distinct main terms of the first `rows` products, sorted, at most `terms`."""
    first = products.select("id", "name").orderBy("id").limit(rows)
    named = first.filter(~tx.is_blank(F.col("name"))).select(tx.main_term(F.col("name")).alias("term"))
    chosen = named.filter(F.length("term") >= 3).distinct().orderBy("term").limit(terms)
    ordered = chosen.agg(F.array_sort(F.collect_list("term")).alias("terms"))
    return ordered.select(F.posexplode("terms").alias("position", "term")).select(
        (F.col("position") + 1).alias("position"), "term"
    )


