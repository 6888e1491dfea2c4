"""Order MinHash: signatures of texts that follow edit distance.

Every k-mer of a text is numbered by its occurrence and ranked by a hash of both. The ranks fall into bins, one hash for all of
them instead of one for each; in a bin the least few are selected, put back into text order and hashed as a tuple. Texts
agree in a bin if they share those k-mers in that order, so moved passages count as changes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import Batches, on_executors
from shelfmark.session import settle

K = 12
BINS = 64
SELECTED = 2
STEP = 1 << 20
BASE = 0x9E3779B97F4A7C15
OTHER = 0xC2B2AE3D27D4EB4F


@cache
def _powers(n: int) -> np.ndarray:
    """Of the base, and of its inverse."""
    out = np.ones((2, n), np.uint64)
    out[0, 1:] = BASE
    out[1, 1:] = pow(BASE, -1, 1 << 64)
    return np.multiply.accumulate(out, 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _kmers(data: np.ndarray) -> np.ndarray:
    """A 32-bit hash of every k-mer; a shorter text is one itself."""
    k = min(K, len(data))
    out = np.empty(len(data) - k + 1 if len(data) else 0, np.uint32)
    ahead, back = _powers(1 << max(10, min(len(data), STEP + K).bit_length()))
    for start in range(0, len(out), STEP):
        part = data[start : start + STEP + k - 1].astype(np.uint64) + np.uint64(1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * ahead[: len(part)], out=sums[1:])
        n = len(part) - k + 1
        out[start : start + n] = _mix((sums[k:] - sums[:-k]) * back[:n]) >> np.uint64(32)
    return out


def signature(text: bytes) -> np.ndarray:
    """BINS numbers of 16 bits; 0 for a bin without a k-mer."""
    kmers = _kmers(np.frombuffer(text, np.uint8))
    n = len(kmers)
    packed = (kmers.astype(np.uint64) << np.uint64(32)) | np.arange(n, dtype=np.uint64)
    packed.sort()
    kmers = packed >> np.uint64(32)
    new = np.ones(n, bool)
    new[1:] = kmers[1:] != kmers[:-1]
    first = np.flatnonzero(new)
    occurrence = np.arange(n) - np.repeat(first, np.diff(np.r_[first, n]))
    rank = _mix(kmers * np.uint64(BASE) + occurrence.astype(np.uint64) * np.uint64(OTHER))
    wanted = 32 * SELECTED * BINS
    if n > 2 * wanted:
        # Far more than a bin selects lie below this limit; if a bin has too few there, all are looked at.
        low = np.flatnonzero((rank << np.uint64(6)) < np.uint64(int(wanted / n * 2**64)))
        if np.bincount((rank[low] >> np.uint64(58)).astype(np.int64), minlength=BINS).min() >= SELECTED:
            rank, kmers, packed = rank[low], kmers[low], packed[low]
    order = np.argsort(rank, kind="stable")
    rank, kmers, place = rank[order], kmers[order], (packed & np.uint64(0xFFFFFFFF))[order].astype(np.int64)
    starts = np.searchsorted(rank, np.arange(BINS, dtype=np.uint64) << np.uint64(58))
    sizes = np.minimum(np.diff(np.r_[starts, len(rank)]), SELECTED)
    out = np.zeros(BINS, np.uint64)
    full = np.flatnonzero(sizes == SELECTED)
    chosen = starts[full][:, None] + np.arange(SELECTED)
    in_order = np.take_along_axis(kmers[chosen], np.argsort(place[chosen], 1), 1)
    tuples = np.zeros(len(full), np.uint64)
    for i in range(SELECTED):
        tuples = _mix(tuples * np.uint64(BASE) + in_order[:, i] + np.uint64(1))
    out[full] = tuples >> np.uint64(48)
    for b in np.flatnonzero((sizes > 0) & (sizes < SELECTED)):
        some = sorted(range(starts[b], starts[b] + sizes[b]), key=lambda i: place[i])
        for i in some:
            out[b] = _mix(out[b : b + 1] * np.uint64(BASE) + kmers[i : i + 1] + np.uint64(1))[0]
        out[b] >>= np.uint64(48)
    return np.where((sizes > 0) & (out == 0), 1, out).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal bins among those that either fills; 1 for two empty texts."""
    filled = (a > 0) | (b > 0)
    return float((a == b)[filled].mean()) if filled.any() else 1.0


def _hexed(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every input row; a null text is empty, with a fingerprint of zeros."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = [_hexed(signature((t or "").encode())) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "fingerprint"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return on_executors(rows, run, "doc_id long, fingerprint string")


RESULT = [
    ("n_chars", pa.int64(), "long"), ("edited_sha256", pa.string(), "string"), ("fingerprint", pa.string(), "string"),
    ("edited_fingerprint", pa.string(), "string"), ("near_edited", pa.float64(), "double"), ("near_next", pa.float64(), "double"),
]


def _compared(text: str, own: np.ndarray, after: str, next_own: np.ndarray) -> tuple:
    quarter = len(text) // 4
    edited = (text[: len(text) - quarter] + after[:quarter]).encode()
    other = signature(edited)
    digest = hashlib.sha256(edited).hexdigest()
    return len(text), digest, _hexed(own), _hexed(other), likeness(own, other), likeness(own, next_own)


# What a task writes: finished rows (kind 0), and the text of its first and of its last row (kinds 1 and 2).
STREAM = [("kind", pa.int8(), "byte"), ("part", pa.int32(), "int"), ("doc_id", pa.int64(), "long"), *RESULT, ("z", pa.binary(), "binary")]


def _batch(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, f[1]) for c, f in zip(columns, fields)], [f[0] for f in fields])


def _stream(batches: Batches) -> Batches:
    part = TaskContext.get().partitionId()
    nothing = (None,) * len(RESULT)
    pack = zstandard.ZstdCompressor(level=1)

    def documents() -> Iterator[tuple]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                rows = batch.slice(first, 256)
                for doc_id, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()):
                    yield doc_id, text or "", signature((text or "").encode())

    before, out = None, []
    for now in documents():
        if before is None:
            out.append((1, part, now[0], *nothing, pack.compress(now[1].encode())))
        else:
            out.append((0, part, before[0], *_compared(*before[1:], *now[1:]), None))
        before = now
        if len(out) == 256:
            yield _batch(out, STREAM)
            out = []
    if before is not None:
        out.append((2, part, before[0], *nothing, pack.compress(before[1].encode())))
    yield _batch(out, STREAM)


def _seams(batches: Batches) -> Batches:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        out = []
        for doc_id, *packed in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "z", "after"))):
            text, after = (unpack.decompress(z).decode() for z in packed)
            out.append((doc_id, *_compared(text, signature(text.encode()), after, signature(after.encode()))))
        yield _batch(out, [("doc_id", pa.int64()), *RESULT])


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Every text against its edited one and the next document's, in ascending order of doc_id (after the last: the first).

    The edited text has its last quarter of code points replaced by as many (or all) first ones of the next document. One
    row per input row: doc_id and the columns of RESULT. Rows are range-partitioned, so a task meets neighbours in
    order; where two partitions meet, the last text of one is compared with the first of the other afterwards. Null
    doc_ids come first, rows of one doc_id in the order of a hash of their texts; a null text is empty; a single row is its own next.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64("text").alias("tie"),
        F.monotonically_increasing_id().alias("row"),
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "tie", "row"]
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    schema = ", ".join(f"{n} {k}" for n, _, k in STREAM)
    streamed = settle(on_executors(ranged, _stream, schema))
    names = [n for n, *_ in RESULT]
    # One row per task.
    ends = streamed.filter("kind > 0")
    firsts = ends.filter("kind = 1").select("part")
    by_part = Window.orderBy("part")
    following = F.coalesce(F.lead("part").over(by_part), F.first("part").over(by_part))
    after = firsts.select(F.col("part").alias("of"), following.alias("next"))
    last = ends.filter("kind = 2").join(after, F.col("part") == F.col("of")).select("doc_id", "z", "next")
    heads = ends.filter("kind = 1").select(F.col("part").alias("head"), F.col("z").alias("after"))
    pairs = last.join(heads, F.col("next") == F.col("head")).select("doc_id", "z", "after")
    sewn = on_executors(pairs, _seams, "doc_id long, " + ", ".join(f"{n} {k}" for n, _, k in RESULT))
    return streamed.filter("kind = 0").select("doc_id", *names).unionByName(sewn)
