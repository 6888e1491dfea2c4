"""Secret scan with corpus-wide ownership: a value seen with few owners is theirs, one seen with many is an example."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import Batches, on_executors
from shelfmark.session import settle

# The base patterns, in the order in which kinds are listed.
KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
WORDS = ("passw", "secret", "token", "api")
#: Shape of other candidates: long runs that mix letters and digits and repeat few of them.
LONG = re.compile(r"[A-Za-z0-9+/_-]{20,}")
BITS = 3.0
#: A candidate in this many repositories, or with this many owners, is a widely copied example.
REPOSITORIES = 3
OWNERS = 3
MASK = "[secret]"


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the base patterns, by start, then kind."""
    found = []
    folded = text.lower()
    if any(w in folded for w in WORDS):
        found += [(*m.span(), "assign", m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if LONG.search(text):
        found += [(*m.span(), "access", m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
        found += [(*m.span(), "hex", m[0]) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def other_spans(text: str, base: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """Candidates that touch no base span: credential-like by their letters, live only if corpus counts agree."""
    out, at = [], 0
    for m in LONG.finditer(text):
        start, end = m.span()
        while at < len(base) and base[at][1] <= start:
            at += 1
        if any(s < end and start < e for s, e, *_ in base[at : at + 1 + len(KINDS)]):
            continue
        value = m[0]
        if re.search("[A-Za-z]", value) and re.search("[0-9]", value) and _bits(value) >= BITS:
            out.append((start, end, "owned", value))
    return out


def _bits(value: str) -> float:
    """Entropy per letter."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


SPAN = "struct<start:long,end:long,kind:string,hash:string>"
COUNTED = "array<struct<start:long,end:long,kind:string,hash:string,repositories:long,owners:long>>"
_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("hash", pa.string())]))


def _hashed(spans: list[tuple[int, int, str, str]]) -> list[tuple]:
    """The values themselves go no further than this."""
    return [(s, e, kind, xxhash.xxh3_128_hexdigest(value.encode())) for s, e, kind, value in spans]


def _candidates(batches: Batches) -> Batches:
    for batch in batches:
        base, more = [], []
        for text in batch.column("text").to_pylist():
            found = base_spans(text or "")
            base.append(_hashed(found))
            more.append(_hashed(other_spans(text or "", found)))
        kept = [batch.column(n) for n in batch.schema.names]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(base, _ARROW), pa.array(more, _ARROW)], [*batch.schema.names, "base", "more"])


def scan(docs: DataFrame, repository: str = "source", owner: str = "source", found_only: bool = False) -> DataFrame:
    """Spans per input row: row (a struct of the columns but text), base, owned, examples.

    With `found_only`, only rows that have candidates are returned, with their text.

    base has the spans of the fixed patterns. Other candidates are counted over the whole table by distinct repositories and
    owners: those below both limits are owned, the rest examples. A span has start, end (code points, exclusive), kind, a hash
    of the value, and the two counts, base spans included, so that a caller can tell copied values there too. A null text
    is empty; a null repository or owner is one of its own; repeated rows count once for their repository.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(
        F.struct(*rest).alias("row"),
        F.coalesce(F.col(f"`{repository}`").cast("string"), F.lit("\0")).alias("repository"),
        F.coalesce(F.col(f"`{owner}`").cast("string"), F.lit("\0")).alias("owner"),
        F.col("text").cast("string").alias("text"),
    )
    spans = T._parse_datatype_string(f"array<{SPAN}>")
    schema = T.StructType([*rows.schema.fields, T.StructField("base", spans), T.StructField("more", spans)])
    found = on_executors(rows, _candidates, schema).withColumn("key", F.monotonically_increasing_id())
    bare = (F.size("base") == 0) & (F.size("more") == 0)
    found = settle(found.filter(~bare) if found_only else found.drop("text"))
    places = found.select(
        "key", "repository", "owner", F.explode(F.concat("base", "more")).alias("span")
    ).select("key", "repository", "owner", "span", "span.hash")
    # Each step combines before its shuffle, so a value copied everywhere is a row per task.
    owners = places.select("hash", "repository", "owner").distinct()
    repositories = owners.select("hash", "repository").distinct().groupBy("hash").agg(F.count("*").alias("repositories"))
    owners = owners.select("hash", "owner").distinct().groupBy("hash").agg(F.count("*").alias("owners"))
    counted = places.join(repositories.join(owners, "hash"), "hash")
    full = F.struct("span.*", "repositories", "owners")
    listed = counted.groupBy("key").agg(F.sort_array(F.collect_list(full)).alias("spans"))
    every = found.filter(bare).withColumn("spans", F.array().cast(COUNTED))
    every = every.unionByName(found.filter(~bare).join(listed, "key"))
    return every.select(
        "row",
        *(["text"] if found_only else []),
        F.filter("spans", lambda s: s["kind"] != KINDS[3]).alias("base"),
        F.filter("spans", lambda s: (s["kind"] == KINDS[3]) & ~_copied(s)).alias("owned"),
        F.filter("spans", lambda s: (s["kind"] == KINDS[3]) & _copied(s)).alias("examples"),
    )


def _copied(span):
    return (span["repositories"] >= REPOSITORIES) | (span["owners"] >= OWNERS)


def _told(batches: Batches) -> Batches:
    """Spans as text, and their digest."""
    for batch in batches:
        columns: list[list] = [[], [], [], [], []]
        for base, owned in zip(batch.column("base").to_pylist(), batch.column("owned").to_pylist()):
            counts = Counter(s["kind"] for s in base)
            told = [",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in _ordered(x)) for x in (base, base + owned)]
            values = [*(counts[k] for k in KINDS[:3]), hashlib.sha256(told[0].encode()).hexdigest(), told[1]]
            for column, value in zip(columns, values):
                column.append(value)
        kinds = [pa.int64()] * 3 + [pa.string()] * 2
        arrays = [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def _ordered(spans: list[dict]) -> list[dict]:
    return sorted(spans, key=lambda s: (s["start"], KINDS.index(s["kind"])))


def report(docs: DataFrame) -> DataFrame:
    """One row per input row: base counts and digest, and all spans: the base ones and the owned."""
    found = scan(docs.select("doc_id", "text", "source"))
    light = found.select(F.col("row.doc_id").cast("long").alias("doc_id"), "base", "owned")
    kinds = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return on_executors(light, _told, kinds)


def _masked(batches: Batches) -> Batches:
    for batch in batches:
        out = []
        for text, base, owned in zip(*(batch.column(n).to_pylist() for n in ("text", "base", "owned"))):
            at, parts = 0, []
            for span in _ordered(base + owned):
                if span["start"] >= at:
                    parts += [text[at : span["start"]], MASK]
                at = max(at, span["end"])
            out.append(text if text is None else "".join([*parts, text[at:]]))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], ["row", "text"])


def _bare(batches: Batches) -> Batches:
    for batch in batches:
        kept = []
        for text in batch.column("text").to_pylist():
            found = base_spans(text or "")
            kept.append(not found and not other_spans(text or "", found))
        yield batch.filter(pa.array(kept, pa.bool_()))


def mask(docs: DataFrame) -> DataFrame:
    """(row, text) with every reported span replaced; overlapping spans become one mask.

    Texts without candidates, nearly all, pass through one scan; only the others are written down and joined.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*rest).alias("row"), F.col("text").cast("string").alias("text"))
    found = scan(docs, found_only=True)
    masked = on_executors(found.select("row", "text", "base", "owned"), _masked, rows.schema)
    return on_executors(rows, _bare, rows.schema).unionByName(masked)
