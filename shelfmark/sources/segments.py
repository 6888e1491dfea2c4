"""A stored search index of the catalog, in segments.

A segment holds what one commit has changed: the term entries of the documents it brings, sorted and cut into ranges of terms, the ids
whose entries in older segments are gone (tombstones), and by how much the counts of words, terms and fields have moved. So counts
are sums over segments, and entries are those of all segments but for the ids that a later one names. The list of segments is
part of the commit file of whoever owns the index, so catalog and index change together.

A new segment takes in the segments before it while these are not FACTOR times as large, so their number grows with the
logarithm of the catalog and a document is rewritten as often. Ranges are set by the first large segment; a search reads the
ranges of its terms only, by partition pruning at run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import schemas as S
from shelfmark.functions import text as tx
from shelfmark.operators import analysis, spelling
from shelfmark.session import fresh_path

FACTOR = 2
#: Documents for each range of terms, and ranges at most.
DOCUMENTS_PER_RANGE = 200_000
RANGES = 256
SORT_TEXTS = ["name", "id", "uniqueKey"]
SORT_NUMBERS = ["price", "updatedAt", "priceChangedAt"]
SORTABLE = SORT_TEXTS + SORT_NUMBERS
DERIVED = {
    "nameSpell": "string",
    "nameSpellClean": "string",
    "uniqueKey": "string",
    "updatedAt": "timestamp_ntz",
    "priceChangedAt": "timestamp_ntz",
}
GONE = "id string"
WORDS = "term string, df long"
TERMS = "field string, term string, df long, cf long"
FIELDS = "field string, n_docs long, total long"
_SORTS = ", ".join(f"{c}: {DERIVED.get(c, S.PRICE.simpleString() if c == 'price' else 'string')}" for c in SORTABLE if c != "id")
ENTRIES = f"field string, term string, id string, tf long, dl int, price {S.PRICE.simpleString()}, sorts struct<{_SORTS}>, range int"


def complete(documents: DataFrame) -> DataFrame:
    """Search documents with all their columns; those a plain product table lacks are null."""
    missing = {c: F.lit(None).cast(kind) for c, kind in DERIVED.items() if c not in documents.columns}
    return documents.withColumns(missing).select("id", "name", "description", "price", *DERIVED)


def sorts() -> Column:
    """The columns that hits can be sorted by, as one."""
    return F.struct(*[F.col(c) for c in SORTABLE if c != "id"]).alias("sorts")


def entries_of(documents: DataFrame) -> DataFrame:
    """Term frequencies of name and description, carrying the columns that filter and sort hits."""
    carried = complete(documents).withColumn("sorts", sorts())
    keep = ["price", "sorts"]
    return analysis.term_frequencies(analysis.standard_fields(carried, keep), keep)


def _code(term: Column) -> Column:
    """The first six bytes as a number, in the order of the terms."""
    return F.conv(F.rpad(F.hex(F.substring(F.encode(term, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("long")


def range_of(term: Column, bounds: Sequence[int]) -> Column:
    if not bounds:
        return F.lit(0)
    code = _code(term)
    return F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= code))


@dataclass(frozen=True)
class Segments:
    """The live segments below `base`, oldest first, as {"number", "docs", "gone"}; `bounds` are where ranges of terms begin."""

    spark: SparkSession
    base: str
    live: list[dict] = field(default_factory=list)
    bounds: list[int] = field(default_factory=list)

    def _path(self, number: int, table: str) -> str:
        return f"{self.base}/version={number}/{table}"

    def _read(self, table: str, schema: str, segments: list[dict] | None = None) -> DataFrame:
        """A table of all segments, with the number of the segment as `segment`."""
        parts = [
            self.spark.read.schema(schema).parquet(self._path(s["number"], table)).withColumn("segment", F.lit(s["number"]))
            for s in (self.live if segments is None else segments)
        ]
        if not parts:
            return self.spark.createDataFrame([], schema).withColumn("segment", F.lit(0))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    # --- what a search reads ---

    def entries(self) -> DataFrame:
        """(field, term, id, tf, dl, price, sorts, range, segment), also those that are gone: see `alive`."""
        return self._read("entries", ENTRIES)

    def _gone(self, segments: list[dict]) -> DataFrame | None:
        """(id, segment): ids whose entries in segments before that one are gone."""
        return self._read("gone", GONE, later) if (later := [s for s in segments if s["gone"]]) else None

    def alive(self, rows: DataFrame, gone: DataFrame | None = None) -> DataFrame:
        """Rows of entries (with id and segment) but those that a later segment says are gone."""
        gone = self._gone(self.live[1:]) if gone is None else gone
        if gone is None:
            return rows.drop("segment")
        last = gone.groupBy(F.col("id").alias("_id")).agg(F.max("segment").alias("_after"))
        return rows.join(last, (F.col("id") == F.col("_id")) & (F.col("segment") < F.col("_after")), "left_anti").drop("segment")

    def _summed(self, table: str, schema: str, keys: list[str]) -> DataFrame:
        rows = self._read(table, schema).drop("segment")
        if len(self.live) < 2:
            return rows
        counts = [c for c in rows.columns if c not in keys]
        return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts]).filter(F.col(counts[0]) > 0)

    def words(self) -> DataFrame:
        """(term, df) over the words of cleaned names."""
        return self._summed("words", WORDS, ["term"])

    def terms(self) -> DataFrame:
        """(field, term, df, cf)."""
        return self._summed("terms", TERMS, ["field", "term"])

    def fields(self) -> DataFrame:
        """(field, n_docs, avg_len), one row per field."""
        return self._summed("fields", FIELDS, ["field"]).select("field", "n_docs", (F.col("total") / F.col("n_docs")).alias("avg_len"))

    def matches(self, expanded: DataFrame, columns: Sequence[str], on: Sequence[str] = ("term",)) -> DataFrame:
        """Columns of the live entries of the terms asked for, beside those of `expanded`."""
        ranged = expanded.withColumn("range", range_of(F.col("term"), self.bounds)).filter(F.col("range") >= 0)
        entries = self.entries().select(*dict.fromkeys([*on, "id", "segment", "range", *columns]))
        return self.alive(entries.join(ranged, [*on, "range"])).drop("range")

    # --- commits ---

    def add(self, number: int, now: DataFrame, before: DataFrame, docs: int) -> tuple[Segments, list[str]]:
        """Write segment `number`: documents as they are now, `docs` of them or about, and as they were before. Returns the index with
        it, and the folders of the segments it has taken in, which may be removed once nobody reads the former index."""
        keep, taken, total = [*self.live], [], max(docs, 1)
        while keep and keep[-1]["docs"] < FACTOR * total:
            taken.insert(0, keep.pop())
            total += taken[0]["docs"]
        fresh, bounds = entries_of(now), self.bounds
        parts = min(RANGES, -(-total // DOCUMENTS_PER_RANGE))
        if not bounds and parts > 1:
            points = F.percentile_approx(_code(F.col("term")), [i / parts for i in range(1, parts)], 10_000).alias("points")
            bounds = sorted(set(fresh.agg(points).first()["points"] or []))
            keep, taken = [], [*keep, *taken]  # all entries are dealt out anew
        here = F.lit(number).alias("segment")
        left = before.select("id", here) if self.live else None
        if taken:
            if (earlier := self._gone(taken[1:])) is not None:
                left = left.unionByName(earlier)
            fresh = fresh.unionByName(self.alive(self._read("entries", ENTRIES, taken), left).select(*fresh.columns))
        if keep:
            ids = [rows for rows in (before.select("id"), self._gone(taken)) if rows is not None]
            gone = ids[0] if len(ids) == 1 else ids[0].unionByName(ids[1].select("id"))
            gone.distinct().write.mode("overwrite").parquet(self._path(number, "gone"))
        fresh = fresh.withColumn("range", range_of(F.col("term"), bounds))
        by_term = fresh.repartitionByRange("term", "id").sortWithinPartitions("range", "term", "id")
        by_term.write.mode("overwrite").partitionBy("range").parquet(self._path(number, "entries"))
        self._counts(number, now, before if self.live else None, taken)
        new = {"number": number, "docs": total, "gone": bool(keep)}
        return replace(self, live=[*keep, new], bounds=bounds), [f"version={s['number']}" for s in taken]

    def _counts(self, number: int, now: DataFrame, before: DataFrame | None, taken: list[dict]) -> None:
        """Counts of words, terms and fields of the segment: up by the documents now, down by those before."""
        sides = [(now, 1)] + ([(before, -1)] if before is not None else [])
        tokens, words = None, None
        for documents, sign in sides:
            tokens_of = analysis.standard_fields(documents).withColumn("sign", F.lit(sign))
            words_of = documents.select(F.explode(spelling.words_of()).alias("term"), F.lit(sign).alias("sign"))
            tokens = tokens_of if tokens is None else tokens.unionByName(tokens_of)
            words = words_of if words is None else words.unionByName(words_of)
        each = tokens.select("field", "id", "sign", F.explode("tokens").alias("term")).groupBy("field", "term", "id", "sign").agg(F.count("*").alias("tf"))
        terms = each.select("field", "term", F.col("sign").cast("long").alias("df"), (F.col("tf") * F.col("sign")).alias("cf"))
        size = F.size("tokens")
        fields = tokens.filter(size > 0).select("field", F.col("sign").cast("long").alias("n_docs"), (size * F.col("sign")).cast("long").alias("total"))
        moved = {
            "words": (words.select("term", F.col("sign").cast("long").alias("df")), WORDS, ["term"]),
            "terms": (terms, TERMS, ["field", "term"]),
            "fields": (fields, FIELDS, ["field"]),
        }
        for table, (rows, schema, keys) in moved.items():
            if taken:
                rows = rows.unionByName(self._read(table, schema, taken).drop("segment"))
            counts = [c for c in rows.columns if c not in keys]
            moves = " or ".join(f"{c} != 0" for c in counts)
            summed = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts]).filter(moves)
            summed.write.mode("overwrite").parquet(self._path(number, table))


def build(documents: DataFrame) -> Segments:
    """An index of documents that are not kept in a store, written to the shared folder."""
    spark = documents.sparkSession
    index, _ = Segments(spark, fresh_path(spark, "index")).add(0, documents, documents.limit(0), documents.count())
    return index
