"""Benchmark decontamination: exact windows of benchmark items in documents, by a prefix-filtered set join.

A window of an item is a set of word shingles, and a document holds the window where it holds all of them in place. Ordered by
rarity in the documents, a set of k shingles of which k must be found has to share its first k - k + 1 = 1 with the document, so
only the rarest shingle of every window is joined. Its place in the window tells where the window would start (positional
bound) and end (length bound); what passes both is compared word by word. All of it are DataFrame functions.

The first scan counts the benchmark's shingles in the documents, the second joins the rarest ones. While the benchmark's windows
take no more than `MOST_BYTES` they are broadcast, so documents are not shuffled at all; beyond, shingles meet in a shuffled
join and documents are shuffled once to be compared.

Documents: a null or empty text has no words; repeated rows and ids are judged row by row; a text of any length is a row of its
own. Items: those without words have no window; rows with the same id are one item, and so are all rows with a null id, whose
name in lists is empty. Empty tables: every document is clean. Columns beside the text are carried, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.session import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words in a window, and in a shingle.
SIZE = 10
SHINGLE = 3
#: Windows are broadcast up to so many bytes: their words and 64 bytes for what stands beside them.
MOST_BYTES = 32 << 20


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _key(words: Column, at: Column, length: int) -> Column:
    """The shingle of so many words at a place, as a hash; null where it would reach over the end."""
    parts = [F.get(words, at + F.lit(i)) for i in range(length)]
    return F.when(at + F.lit(length) <= F.size(words), F.xxhash64(*parts))


def _keyed(texts: DataFrame, lengths: list[int]) -> DataFrame:
    """All shingles of (`carried`, text) as (`carried`, words, pos, key), and a row without a key for each text."""
    carried = [c for c in texts.columns if c != "text"]
    tokens = texts.select(*carried, words_of(F.col("text")).alias("words"))
    places = tokens.select(*carried, "words", F.posexplode(F.array_append("words", F.lit(""))).alias("pos", "_word"))
    keys = [_key(F.col("words"), F.col("pos"), n) for n in lengths]
    if len(keys) == 1:
        return places.select(*carried, "words", "pos", keys[0].alias("key"))
    last = F.col("pos") == F.size("words")
    several = F.when(last, F.array(F.lit(None).cast("long"))).otherwise(F.array(*keys))
    return places.select(*carried, "words", "pos", F.explode(several).alias("key"))


def windows_of(items: DataFrame, id_column: str, size: int) -> tuple[DataFrame, DataFrame]:
    """The distinct windows (window, words, length) and the items that have them (window, item)."""
    named = items.select(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("words"))
    length = F.least(F.size("words"), F.lit(size))
    starts = F.sequence(F.lit(0), F.size("words") - length)
    cut = (
        named.filter(F.size("words") > 0)
        .select("item", "words", length.alias("length"), F.explode(starts).alias("start"))
        .select("item", "length", F.slice("words", F.col("start") + 1, F.col("length")).alias("words"))
    )
    having = settle(cut.distinct())
    distinct = having.select("words", "length").distinct()
    windows = settle(distinct.select(F.monotonically_increasing_id().alias("window"), "words", "length"))
    return windows, having.join(windows.select("window", "words"), "words").select("window", "item")


def _rarest(windows: DataFrame, texts: DataFrame, shingle: int, small: bool) -> DataFrame:
    """The windows with the key and place (`offset`) of their rarest shingle; of equally rare ones the least key, at its first place."""
    length = F.least(F.col("length"), F.lit(shingle))
    lengths = [r[0] for r in windows.select(length).distinct().collect()]  # at most `shingle` numbers
    places = windows.select("*", F.explode(F.sequence(F.lit(0), F.col("length") - length)).alias("offset"))
    key = F.coalesce(*[F.when(length == n, _key(F.col("words"), F.col("offset"), n)) for n in lengths]) if lengths else F.lit(0)
    keyed = settle(places.select("window", "offset", key.cast("long").alias("key")))
    asked = keyed.select("key").distinct()
    found = _keyed(texts.select("text"), sorted(lengths) or [shingle]).select("key")
    counts = found.join(F.broadcast(asked) if small else asked, "key", "left_semi").groupBy("key").agg(F.count("*").alias("n"))
    ranked = keyed.join(settle(counts), "key", "left").select("*", F.coalesce("n", F.lit(0)).alias("seen"))
    first = ranked.groupBy("window").agg(F.min(F.struct("seen", "key", "offset")).alias("first"))
    # A window whose rarest shingle is nowhere occurs nowhere.
    return windows.join(first.filter(F.col("first.seen") > 0), "window").select(
        "window", "words", "length", F.col("first.key").alias("key"), F.col("first.offset").alias("offset"), length.alias("taken")
    )


def _found(texts: DataFrame, rare: DataFrame, small: bool) -> DataFrame:
    """(id, row, n_words) once for each text, and (id, start, length, window) for each window found."""
    lengths = sorted(r[0] for r in rare.select("taken").distinct().collect()) or [SHINGLE]
    start = F.col("pos") - F.col("offset")
    fits = (start >= 0) & (start + F.col("length") <= F.size("words"))
    if small:
        # A row without a key (as 0) meets the entry without words, so that every text comes through with an id given once.
        entries = rare.select("window", F.col("words").alias("sought"), "length", "offset", F.col("key").alias("entry"))
        none = [F.lit(0 if c == "entry" else None).cast(t).alias(c) for c, t in entries.dtypes]
        entries = entries.unionByName(texts.sparkSession.range(1).select(*none))
        numbered = texts.withColumn("id", F.monotonically_increasing_id())
        met = _keyed(numbered, lengths).join(F.broadcast(entries), F.coalesce("key", F.lit(0)) == F.col("entry"))
        whole = F.col("pos") == F.size("words")
        same = F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("length")) == F.col("sought")
        kept = met.filter(F.when(whole, F.col("window").isNull()).otherwise(F.col("window").isNotNull() & fits & same))
        return kept.select(
            "id", F.when(whole, F.col("row")).alias("row"), F.when(whole, F.size("words")).alias("n_words"), start.alias("start"), "length", "window"
        )
    numbered = settle(texts.withColumn("id", F.monotonically_increasing_id()))
    near = _keyed(numbered.select("id", "text"), lengths).select("id", "pos", "key", F.size("words").alias("n"))
    places = rare.select("key", "window", "length", "offset")
    meet = near.join(settle(places), "key").filter((start >= 0) & (start + F.col("length") <= F.col("n")))
    maybe = settle(meet.select("id", start.alias("start"), "length", "window"))
    whole = numbered.select("id", words_of(F.col("text")).alias("words"))
    cut = maybe.join(whole, "id").select("id", "start", "length", "window", F.slice("words", F.col("start") + 1, F.col("length")).alias("words"))
    sure = cut.join(rare.select("window", F.col("words").alias("sought")), "window").filter(F.col("words") == F.col("sought"))
    rows = numbered.select("id", "row", F.size(words_of(F.col("text"))).alias("n_words"))
    return rows.unionByName(sure.select("id", "start", "length", "window"), allowMissingColumns=True)


def _merged(hits: Column) -> Column:
    """Spans of words covered by sorted hits; those that overlap or touch are one."""

    def step(spans: Column, hit: Column) -> Column:
        start, end = hit["start"], hit["start"] + hit["length"]
        last = F.try_element_at(spans, F.lit(-1))
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        joined = F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], end).alias("end")))
        grown = F.concat(F.slice(spans, F.lit(1), F.size(spans) - 1), joined)
        return F.when((F.size(spans) > 0) & (last["end"] >= start), grown).otherwise(F.concat(spans, span))

    return F.aggregate(hits, F.array().cast("array<struct<start:int,end:int>>"), step)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "item_id",
    size: int = SIZE,
    shingle: int = SHINGLE,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """For each document: `row` (its columns but the text), n_words, `spans` (word positions, end exclusive) that lie in windows of
    items, and `items`, the sorted ids of these."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    row = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    texts = docs.select(row.alias("row"), F.col("text").cast("string").alias("text"))
    windows, having = windows_of(benchmark, id_column, size)
    total = windows.agg(F.sum(F.length(F.array_join("words", " ")) * 4 + 64)).first()[0] or 0
    small = total <= most_bytes
    rare = settle(_rarest(windows, texts, min(shingle, size), small))
    hit = F.when(F.col("window").isNotNull(), F.struct("start", "length", "window"))
    rows = settle(
        _found(texts, rare, small)
        .groupBy("id")
        .agg(F.first("row", ignorenulls=True).alias("row"), F.max("n_words").alias("n_words"), F.sort_array(F.collect_set(hit)).alias("hits"))
        .select("id", "row", "n_words", _merged(F.col("hits")).alias("spans"), F.array_distinct(F.transform("hits", lambda h: h["window"])).alias("windows"))
    )
    pairs = rows.filter(F.size("windows") > 0).select("id", F.explode("windows").alias("window"))
    items = pairs.join(settle(having), "window").groupBy("id").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return rows.join(items, "id", "left").select(
        "row", "n_words", "spans", F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract of op11: counts and a digest for each document."""
    found = decontaminate(docs.select("doc_id", "text"), benchmark)
    n_hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
