"""Exact repeats of a byte length and more, across and within documents, by distributed prefix doubling.

A position is known by the rank of the string that starts a fixed way from it. Ranks are fingerprints, so equal strings have
equal ranks on every executor and no round needs a global renumbering; a round sorts (shuffles) positions by the pair of
their previous rank and the fingerprint of their longer string, drops what is unique, and goes on with a longer one until
the threshold is reached. Two things keep the sorted rows few:

* Round 0 sorts anchors only: in every window of `length` bytes, the gram (a third of that) with the least hash, the leftmost of
  equals. Equal windows have equal anchors at equal distances, so a window whose anchor's gram is unique is unique too.
* The windows of one anchor stay together as a run, compared as blocks of 16 windows and only then one by one. What all windows
  of a block have in common must repeat, or the block is done; if all that the block covers repeats as a whole,
  every window in it repeats, and only one of the equal blocks goes on, as a witness for others that are partly equal.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import Batches, on_executors
from shelfmark.session import settle

LENGTH = 200
BLOCK = 16
#: Windows hashed at a time; positions in a piece take 20 bits beside 44 of a hash.
STEP = 1 << 18
BASE = 0x9E3779B97F4A7C15
WORD = (1 << 64) - 1


@cache
def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


@cache
def _letters() -> np.ndarray:
    return np.random.default_rng(5).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Prints:
    """Fingerprints of any substrings of some bytes, from sums of letter times power."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        size = 1 << max(10, int(n).bit_length())
        self.back = _powers(pow(BASE, -1, 1 << 64), size)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_letters()[data] * _powers(BASE, size)[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray, more: np.ndarray | int = 0) -> np.ndarray:
        own = (self.sums[end] - self.sums[start]) * self.back[start]
        return _mix(_mix(own) + np.asarray(more).astype(np.uint64) * np.uint64(BASE)).view(np.int64)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours."""
    n, padded = len(values), -(-len(values) // width) * width
    rows = np.full(padded, WORD, np.uint64)
    rows[:n] = values
    rows = rows.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _runs(data: np.ndarray, ends: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """The runs of windows with one anchor in concatenated texts: anchor, first and last window, both ranks."""
    n, gram = len(data), max(1, length // 3)
    empty = {name: np.zeros(0, np.int64) for name in ("k", "f", "at", "s0", "s1")}
    if n < length:
        return empty
    prints = Prints(data)
    grams = (prints.sums[gram:] - prints.sums[:-gram]) * prints.back[: n - gram + 1]
    place = np.arange(n - gram + 1, dtype=np.uint64)
    low = np.uint64((1 << 20) - 1)
    anchor = (_least((_mix(grams) & ~low) | place, length - gram + 1) & low).astype(np.int64)
    crossing = np.zeros(n + 1, np.int32)
    np.add.at(crossing, np.maximum(ends - length + 1, 0), 1)
    np.add.at(crossing, ends, -1)
    window = np.flatnonzero(np.cumsum(crossing)[: n - length + 1] == 0)
    if not len(window):
        return empty
    at = anchor[window]
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)])
    s0, s1, at = window[new], window[np.r_[new[1:], len(window)] - 1], at[new]
    k = prints.of(at, at + gram)
    return {"k": k, "f": prints.of(s0, s1 + length, ((at - s0) << 32) + (s1 - s0)), "at": at, "s0": s0, "s1": s1}


def _pieces(batch: pa.RecordBatch, length: int) -> Iterator[tuple[list, list, list]]:
    """Texts of a batch, long ones cut with an overlap, in groups of about STEP bytes: keys, offsets, bytes."""
    unpack = zstandard.ZstdDecompressor()
    keys, offsets, parts, total = [], [], [], 0
    for key, packed in zip(batch.column("key").to_pylist(), batch.column("z").to_pylist()):
        text = unpack.decompress(packed)
        for start in range(0, max(1, len(text) - length + 1), STEP):
            part = text[start : start + STEP + length - 1] if len(text) > STEP else text
            keys.append(key)
            offsets.append(start)
            parts.append(part)
            total += len(part)
            if total >= STEP:
                yield keys, offsets, parts
                keys, offsets, parts, total = [], [], [], 0
    if parts:
        yield keys, offsets, parts


def _anchors(length: int, names: list[str]):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for keys, offsets, parts in _pieces(batch, length):
                sizes = np.fromiter(map(len, parts), np.int64, len(parts))
                ends = np.cumsum(sizes)
                found = _runs(np.frombuffer(b"".join(parts), np.uint8), ends, length)
                part = np.searchsorted(ends, found["s0"], "right")
                shift = np.array(offsets, np.int64)[part] - (ends - sizes)[part]
                found = {n: v + shift if n in ("at", "s0", "s1") else v for n, v in found.items()}
                found["key"] = np.array(keys, np.int64)[part]
                yield pa.RecordBatch.from_arrays([pa.array(found[n]) for n in names], names)

    return run


def _contexts(length: int):
    """The bytes that the windows of chosen runs cover."""

    def run(batches: Batches) -> Batches:
        names = ["key", "base", "h", "at", "s0", "s1", "witness", "bytes"]
        kinds = [pa.int64()] * 6 + [pa.bool_(), pa.binary()]
        for batch in batches:
            unpack = zstandard.ZstdDecompressor()
            rows: list[tuple] = []
            columns = (batch.column(n).to_pylist() for n in ("key", "z", "runs"))
            for key, packed, runs in zip(*columns):
                text = unpack.decompress(packed)
                rows += [
                    (key, r["s0"], r["h"], r["at"], r["s0"], r["s1"], r["witness"], text[r["s0"] : r["s1"] + length])
                    for r in runs
                ]
            arrays = [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


ITEM = ["k", "f", "key", "base", "h", "at", "s0", "s1", "witness"]


def _blocks(length: int, size: int):
    """Blocks of `size` windows, counted from the anchor, with the ranks of what they share and what they cover."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                rows = batch.slice(first, 1024)
                if rows.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cut(rows)], ITEM)

    def cut(rows: pa.RecordBatch) -> list[np.ndarray]:
        parts = rows.column("bytes").to_pylist()
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        prints = Prints(np.frombuffer(b"".join(parts), np.uint8))
        key, base, h, at, s0, s1, witness = (
            rows.column(n).to_numpy(zero_copy_only=False) for n in ("key", "base", "h", "at", "s0", "s1", "witness")
        )
        shift = np.cumsum(sizes) - sizes - base
        low, high = (at - s1) // size, (at - s0) // size
        many = high - low + 1
        row = np.repeat(np.arange(len(parts)), many)
        block = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + low[row]
        last = at[row] - block * size
        start, end = np.maximum(last - size + 1, s0[row]), np.minimum(last, s1[row])
        shared = prints.of(last + shift[row], last - size + 1 + length + shift[row], h[row].view(np.uint64) + block.astype(np.uint64))
        covered = prints.of(start + shift[row], end + length + shift[row], ((last - start) << 32) + (end - start))
        return [shared, covered, key[row], base[row], h[row], at[row], start, end, witness[row]]

    return run


ITEM_SCHEMA = "k long, f long, key long, base long, h long, at long, s0 long, s1 long, witness boolean"


def _round(items: DataFrame, length: int, last: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """Spans of the runs that repeat as a whole, and one run for each different one of a group that must be split."""
    one = F.min(F.struct("key", "base", "at", "s0", "s1", "h")).alias("one")
    classes = items.groupBy("k", "f").agg(F.count("*").alias("n"), F.max("witness").alias("seen"), one)
    classes = classes if last else settle(classes)
    whole = settle(classes.filter(F.col("n") > 1).select("k", "f"))
    spans = (
        items.filter(~F.col("witness"))
        .join(whole, ["k", "f"], "left_semi")
        .select("key", F.col("s0").alias("start"), (F.col("s1") + F.lit(length)).alias("end"))
    )
    if last:
        return spans, None
    # Written down, so that both sides of the join are plain shuffles, whose large partitions Spark can split.
    mixed = settle(classes.groupBy("k").count().filter(F.col("count") > 1).select("k"))
    witness = (F.col("seen") | (F.col("n") > 1)).alias("witness")
    return spans, classes.join(mixed, "k", "left_semi").select("one.*", witness)


def _packed(batches: Batches) -> Batches:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        bodies = [pack.compress(t or b"") for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("row"), pa.array(bodies, pa.binary())], ["key", "row", "z"])


SPANS = "array<struct<start:long,end:long>>"


def _kept(as_text: bool):
    """Unite the spans of each text and cut them out."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(text: bytes, spans: list[dict]) -> tuple[list[dict], bytes]:
        merged: list[dict] = []
        for span in sorted(spans, key=lambda s: s["start"]):
            if merged and span["start"] <= merged[-1]["end"]:
                merged[-1]["end"] = max(merged[-1]["end"], span["end"])
            else:
                merged.append(dict(span))
        stops = [0, *(s["end"] for s in merged)]
        starts = [*(s["start"] for s in merged), len(text)]
        return merged, b"".join(text[a:b] for a, b in zip(stops, starts))

    def run(batches: Batches) -> Batches:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            sizes, united, kept = [], [], []
            for packed, spans in zip(batch.column("z").to_pylist(), batch.column("found").to_pylist()):
                text = unpack.decompress(packed)
                merged, rest = cut(text, spans or [])
                sizes.append(len(text))
                united.append(merged)
                kept.append(rest.decode("utf-8", "ignore") if as_text else rest)
            arrays = [batch.column("row"), pa.array(sizes, pa.int64()), pa.array(united, kind)]
            arrays.append(pa.array(kept, pa.string() if as_text else pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, ["row", "n_bytes", "spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, as_text: bool = False) -> DataFrame:
    """Cut every byte covered by a `length`-byte string that also starts anywhere else.

    Returns for every input row: row (a struct of its columns but text), n_bytes, spans (the maximal removed runs, in
    bytes, end exclusive) and kept (the remaining bytes, or as a text without what a cut leaves of a character). A null text is empty; repeated rows are texts of their own,
    so long enough ones go wholly; texts below `length` bytes lose nothing. Overlapping repeats in one text count.
    Equality of strings is that of 128 bits of fingerprints.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(
        F.monotonically_increasing_id().alias("key"), F.struct(*rest).alias("row"), F.col("text").cast("string").alias("text")
    )
    row = T.StructField("row", rows.schema["row"].dataType)
    schema = T.StructType([T.StructField("key", T.LongType()), row, T.StructField("z", T.BinaryType())])
    packed = settle(on_executors(rows, _packed, schema))
    bodies = packed.select("key", "z")

    names = ["k", "f", "key", "at", "s0", "s1"]
    grams = on_executors(bodies, _anchors(length, ["k"]), "k long").groupBy("k").count()
    repeated = settle(grams.filter(F.col("count") > 1).select("k"))
    anchors = on_executors(bodies, _anchors(length, names), ", ".join(f"{n} long" for n in names))
    items = anchors.join(repeated, "k", "left_semi").select(
        "k", "f", "key", F.col("s0").alias("base"), F.col("k").alias("h"), "at", "s0", "s1", F.lit(False).alias("witness")
    )
    whole, ones = _round(settle(items), length)

    runs = ones.groupBy("key").agg(F.collect_list(F.struct("h", "at", "s0", "s1", "witness")).alias("runs"))
    kind = "key long, base long, h long, at long, s0 long, s1 long, witness boolean, bytes binary"
    contexts = settle(on_executors(bodies.join(runs, "key"), _contexts(length), kind))
    items = settle(on_executors(contexts, _blocks(length, BLOCK), ITEM_SCHEMA))
    blocks, ones = _round(items, length)

    of = contexts.select("key", "base", "bytes")
    single = on_executors(ones.join(of, ["key", "base"]), _blocks(length, 1), ITEM_SCHEMA)
    windows, _ = _round(settle(single.select("k", F.lit(0).alias("f"), *ITEM[2:])), length, last=True)

    found = whole.unionByName(blocks).unionByName(windows)
    spans = found.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    out = T.StructType(
        [row, T.StructField("n_bytes", T.LongType()), T.StructField("spans", T._parse_datatype_string(SPANS)), T.StructField("kept", T.StringType() if as_text else T.BinaryType())]
    )
    return on_executors(packed.join(spans, "key", "left"), _kept(as_text), out)


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per input row: doc_id, bytes, bytes removed, runs removed, digest of the rest."""
    cut = remove_repeats(docs.select("doc_id", "text"), length)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
