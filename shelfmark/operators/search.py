"""Answering a table of search requests against the catalog, by its stored index (`sources/segments.py`).

Requests that ask for the same thing (same tokens, price bounds and sort) form one spec; hits are computed once
per spec and handed back to its requests page by page, so popular requests cost no more than rare ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark import schemas as S
from shelfmark.functions import text as tx
from shelfmark.operators import analysis, skew, spelling
from shelfmark.operators.fuzzy import edit_budget, fuzzy_join, similarity
from shelfmark.session import settle
from shelfmark.sources import segments
from shelfmark.sources.segments import SORT_NUMBERS, SORT_TEXTS, SORTABLE, Segments, complete, sorts

# Field weights, and how many hits count as few.
BOOSTS = {analysis.NAME: 3.0, analysis.DESCRIPTION: 1.0}
DEEP = 1000
FEW_HITS = 3
# What a request without them means.
PAGE, SIZE, SORT = 0, 12, "price,asc"


def prepare(requests: DataFrame, text: str = "query") -> DataFrame:
    """Add tokens, sort field and direction, paging depth and the spec the request belongs to.

    A missing page, size or sort has its default. A request with an unknown sort field, a negative page or an empty page size
    is refused: it keeps its row, with an `error` and no spec.
    """
    requests = requests.withColumns(
        {
            "page": F.coalesce("page", F.lit(PAGE)),
            "size": F.coalesce("size", F.lit(SIZE)),
            "sort": F.coalesce("sort", F.lit(SORT)),
        }
    )
    parts = F.split("sort", ",")
    tokens = F.array_sort(F.array_distinct(tx.standard_tokens(F.col(text))))
    ready = requests.withColumns(
        {
            "match_all": tx.is_blank(F.col(text)),
            "tokens": tokens,
            "sort_field": parts[0],
            "descending": F.coalesce(F.lower(F.get(parts, F.lit(1))) == "desc", F.lit(False)),
            "depth": (F.col("page").cast("bigint") + 1) * F.col("size"),
        }
    )
    error = (
        F.when(F.col("page") < 0, "negative page")
        .when(F.col("size") < 1, "empty page")
        .when(~F.col("sort_field").isin(*SORTABLE), "unknown sort field")
    )
    identity = F.struct("match_all", "tokens", "min_price", "max_price", "sort_field", "descending")
    return ready.withColumn("error", error).withColumn("spec_key", F.when(F.col("error").isNull(), F.to_json(identity)))


def specs(prepared: DataFrame) -> DataFrame:
    """One row per distinct spec that is not refused; its id is the smallest query id asking for it."""
    prepared = prepared.filter(F.col("error").isNull())
    same = ["match_all", "tokens", "min_price", "max_price", "sort_field", "descending"]
    return prepared.groupBy("spec_key").agg(
        F.min("query_id").alias("spec_id"),
        F.max("depth").alias("depth"),
        *[F.first(c).alias(c) for c in same],
    )


def expand(specs: DataFrame, terms: DataFrame, fuzzy: bool) -> DataFrame:
    """(spec_id, term, similarity, bounds): the indexed terms each spec's tokens stand for."""
    asked = specs.filter(~F.col("match_all")).select(
        "spec_id", "min_price", "max_price", F.explode("tokens").alias("token")
    )
    budget = edit_budget(F.col("token")) if fuzzy else F.lit(0)
    pairs = fuzzy_join(asked.select("token", budget.alias("edits")), terms.select("term").distinct())
    weight = similarity(F.col("distance"), F.col("token"), F.col("term"))
    meanings = pairs.withColumn("similarity", weight).drop("distance")
    found = skew.join(asked, meanings, ["token"])
    return found.groupBy("spec_id", "term").agg(
        F.max("similarity").alias("similarity"),
        F.first("min_price").alias("min_price"),
        F.first("max_price").alias("max_price"),
    )


def _in_bounds() -> Column:
    price = F.col("price").cast("double")
    low = F.col("min_price").isNull() | (price >= F.col("min_price"))
    high = F.col("max_price").isNull() | (price <= F.col("max_price"))
    return low & high


def text_matches(expanded: DataFrame, index: Segments) -> DataFrame:
    """(spec_id, id, field, term, similarity, price, sorts) within the price bounds."""
    return index.matches(expanded, ["field", "price", "sorts"]).filter(_in_bounds())


def text_hits(expanded: DataFrame, index: Segments) -> DataFrame:
    matched = index.matches(expanded, ["price", "sorts"]).filter(_in_bounds())
    return matched.groupBy("spec_id", "id").agg(F.first("sorts").alias("sorts"))


def _price_band(price: Column) -> Column:
    """Logarithmic band, 23 per factor of ten; NUMERIC(10,2) has fewer than 250 of them."""
    return F.floor(F.log(F.greatest(price.cast("double"), F.lit(0.01))) * 10).cast("int")


LOWEST_BAND, HIGHEST_BAND = -47, 185


def listing_hits(specs: DataFrame, products: DataFrame) -> DataFrame:
    """Hits of specs without text: an equi-join on price bands, then the exact bounds."""
    low = F.when(F.col("min_price").isNull(), LOWEST_BAND).otherwise(_price_band(F.col("min_price")))
    high = F.when(F.col("max_price").isNull(), HIGHEST_BAND).otherwise(_price_band(F.col("max_price")))
    high = F.least(high, F.lit(HIGHEST_BAND))
    asked = (
        specs.filter("match_all")
        .withColumns({"_low": low, "_high": high})
        .filter("_low <= _high")
        .select("spec_id", "min_price", "max_price", F.explode(F.sequence("_low", "_high")).alias("band"))
    )
    band = F.when(F.col("price").isNull(), LOWEST_BAND).otherwise(_price_band(F.col("price")))
    banded = complete(products).select("id", "price", sorts(), band.alias("band"))
    return skew.join(banded, asked, ["band"]).filter(_in_bounds()).select("spec_id", "id", "sorts")


def hits(specs: DataFrame, products: DataFrame, index: Segments, expanded: DataFrame) -> DataFrame:
    """(spec_id, id, sorts): every product each spec matches, once."""
    return text_hits(expanded, index).unionByName(listing_hits(specs, products))


def scores(expanded: DataFrame, index: Segments) -> DataFrame:
    """(spec_id, id, score): BM25 per field with its boost, the best field counts."""
    weights = (
        index.terms().join(F.broadcast(index.fields()), "field")
        .withColumn("_idf", analysis.idf(F.col("n_docs"), F.col("df")))
        .select("field", "term", "_idf", "avg_len")
    )
    asked = expanded.join(weights, "term")
    matched = index.matches(asked, ["price", "tf", "dl"], on=("field", "term")).filter(_in_bounds())
    boost = F.create_map(*[F.lit(v) for pair in BOOSTS.items() for v in pair])[F.col("field")]
    part = boost * F.col("similarity") * F.col("_idf") * analysis.term_weight(
        F.col("tf"), F.col("dl"), F.col("avg_len")
    )
    per_field = matched.groupBy("spec_id", "id", "field").agg(F.sum(part).alias("_score"))
    return per_field.groupBy("spec_id", "id").agg(F.max("_score").alias("score"))


def _order() -> list[Column]:
    return [
        F.col("_number").asc_nulls_last(),
        F.col("_up").asc_nulls_last(),
        F.col("_down").desc_nulls_last(),
        F.col("id"),
    ]


def top_parts(specs: DataFrame, hits: DataFrame) -> DataFrame:
    """The first hits of each part of a spec down to its depth, and on the first of them the part's number of hits.

    A spec has as many parts as there are shuffle partitions. One pass yields both the totals and all that pages can
    show; hits beyond a spec's depth are counted and go no further.
    """
    asked = specs.select("spec_id", "sort_field", "descending", "depth")
    parts = int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = skew.join(hits, asked, ["spec_id"])
    field, descending = F.col("sort_field"), F.col("descending")
    number = F.coalesce(*[F.when(field == c, _number_of(c)) for c in SORT_NUMBERS])
    text = F.coalesce(*[F.when(field == c, F.col("id") if c == "id" else F.col(f"sorts.{c}")) for c in SORT_TEXTS])
    rows = rows.select(
        "spec_id",
        "id",
        "depth",
        F.when(descending, -number).otherwise(number).alias("_number"),
        F.when(~descending, text).alias("_up"),
        F.when(descending, text).alias("_down"),
        F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part"),
    )
    inside = Window.partitionBy("spec_id", "part")
    place = F.row_number().over(inside.orderBy(*_order()))
    counted = rows.withColumns({"place": place, "n": F.count("*").over(inside)}).filter("place <= depth")
    return counted.withColumn("n", F.when(F.col("place") == 1, F.col("n"))).drop("place", "part")


def _number_of(column: str) -> Column:
    value = F.col(f"sorts.{column}")
    return value.cast("double") if column == "price" else value.cast("timestamp").cast("double")


def totals(prepared: DataFrame, specs: DataFrame, top: DataFrame) -> DataFrame:
    """Every request with its spec and number of hits; a refused one has neither."""
    found = top.groupBy("spec_id").agg(F.sum("n").alias("total_hits"))
    summary = (
        specs.select("spec_key", "spec_id")
        .join(found, "spec_id", "left")
        .withColumn("total_hits", F.coalesce("total_hits", F.lit(0)))
    )
    return skew.join(prepared, summary, ["spec_key"], "left")


def pages(members: DataFrame, top: DataFrame) -> DataFrame:
    """The requested page of every request: (query_id, spec_id, rank, id, total_hits, total_pages); rank counts from 1."""
    deep = not members.filter(F.col("error").isNull() & (F.col("depth") > DEEP)).isEmpty()
    final = F.row_number().over(Window.partitionBy("spec_id").orderBy(*_order()))
    ranked = top.filter(F.col("depth") <= DEEP).withColumn("rank", final).select("spec_id", "rank", "id")
    if deep:
        # Without putting the many rows of such a spec into one task.
        far = skew.distributed_rank(top.filter(F.col("depth") > DEEP), ["spec_id"], _order())
        ranked = ranked.unionByName(far.select("spec_id", "rank", "id"))
    wanted = members.filter(F.col("error").isNull()).select(
        "query_id",
        "spec_id",
        "size",
        F.col("page").cast("bigint").alias("page"),
        "total_hits",
        F.ceil(F.col("total_hits") / F.col("size")).alias("total_pages"),
    )
    # A spec's rows are cut into pages once for every page size it is asked for.
    sizes = wanted.select("spec_id", "size").distinct()
    cut = skew.join(ranked, sizes, ["spec_id"]).withColumn("page", F.floor((F.col("rank") - 1) / F.col("size")))
    return skew.join(wanted, cut, ["spec_id", "size", "page"]).select(
        "query_id", "spec_id", "rank", "id", "total_hits", "total_pages"
    )


class Search:
    """One run of a table of requests against search documents and their index: correct, match, count, page and highlight.

    Without an index the documents are indexed first. What matches are counted and cut to the rows that pages can show as
    they are found; no step stores all hits, and none takes the documents' texts apart but of those shown.
    """

    def __init__(self, requests: DataFrame, documents: DataFrame, corrected: bool = True, index: Segments | None = None) -> None:
        self.documents = complete(documents)
        self.index = index or segments.build(documents)
        if corrected:
            requests = settle(spelling.correct(requests, self.index.words()))
        self.requests = requests
        self.prepared = prepare(requests, "corrected" if corrected else "query")
        self.specs = settle(specs(self.prepared))
        self.expanded = settle(expand(self.specs, self.index.terms(), fuzzy=True))
        self.top = settle(top_parts(self.specs, hits(self.specs, self.documents, self.index, self.expanded)))
        self.members = settle(totals(self.prepared, self.specs, self.top))

    def pages(self) -> DataFrame:
        return pages(self.members, self.top)

    def rows(self) -> DataFrame:
        """The whole document of every hit shown, its matched words marked, and what the request asked."""
        shown = settle(self.pages())
        texts = settle(skew.join(shown.select("spec_id", "id").distinct(), self.documents, ["id"]))
        said = F.array_distinct(F.concat(*[F.coalesce(tx.standard_tokens(F.col(c)), F.array()) for c in ("name", "description")]))
        own = texts.select("spec_id", "id", F.explode(said).alias("term"))
        matched = skew.join(own, self.expanded.select("spec_id", "term"), ["spec_id", "term"])
        terms = matched.groupBy("spec_id", "id").agg(F.collect_set("term").alias("terms"))
        texts = texts.join(terms, ["spec_id", "id"], "left")
        marked = {c: tx.highlight(F.col(c), F.col("terms")) for c in ("name", "description")}
        changed = F.lower("corrected") != F.lower("query")
        notes = self.requests.select("query_id", F.when(changed, F.col("corrected")).alias("corrected_query"))
        return (
            skew.join(shown, texts.withColumns(marked).drop("terms"), ["spec_id", "id"])
            .join(notes, "query_id")
            .drop("spec_id")
        )

    def summary(self) -> DataFrame:
        """(query_id, corrected_query, suggestions, total_hits, error) of every request."""
        return final_suggestions(self.members, self.documents)


def search(requests: DataFrame, documents: DataFrame, index: Segments | None = None) -> tuple[DataFrame, DataFrame]:
    """The hits of every request's page, and one summary row per request."""
    run = Search(requests, documents, index=index)
    return run.rows(), run.summary()


def final_suggestions(members: DataFrame, products: DataFrame) -> DataFrame:
    """Spell suggestions; with none and few hits the catalog's own terms; with none of these fixed terms.

    A refused request has none, but its row and its error.
    """
    terms = spelling.catalog_vocabulary(products).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "term"))), lambda t: t["term"]).alias("_terms")
    )
    fallback = F.array(*[F.lit(t) for t in S.FALLBACK_SUGGESTIONS])
    offered = terms.select(F.when(F.size("_terms") > 0, F.col("_terms")).otherwise(fallback).alias("_offered"))
    few = (F.size("suggestions") == 0) & (F.col("total_hits") <= FEW_HITS)
    return members.withColumn("_offered", offered.scalar()).select(
        "query_id",
        F.col("corrected").alias("corrected_query"),
        F.when(F.col("error").isNull(), F.when(few, F.col("_offered")).otherwise(F.col("suggestions"))).alias("suggestions"),
        "total_hits",
        "error",
    )
