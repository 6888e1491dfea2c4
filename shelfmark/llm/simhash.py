"""SimHash near-duplicates: popcount embedding, grid range-join under Manhattan distance, exact check."""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import Batches, components, on_executors, texts
from shelfmark.session import settle

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Two-bit segments of a fingerprint, each embedded as its number of set bits.
SEGMENTS = 32
LOW_BITS = 0x5555555555555555
#: Rows of a cell that are compared with each other in one task.
CHUNK = 1024
#: What a row of a grid costs to write, shuffle and sort, in comparisons of two rows.
ROW_COST = 150
CELL = ["grid", "cell", "part_a", "part_b"]


def fingerprint(text: bytes | None) -> int:
    """The 64-bit fingerprint as a signed number; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) < SHINGLE:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[: 1 - SHINGLE - 1]])
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[s:e], SEED) for s, e in zip(starts.tolist(), (ends[SHINGLE - 1 :] - 1).tolist())]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = np.array(hashes[at : at + (1 << 14)], np.uint64).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def _fingerprints(batches: Batches) -> Batches:
    for batch in batches:
        prints = pa.array([fingerprint(text) for text in texts(batch)], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), prints], ["doc_id", "print"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, print): one row per input row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return on_executors(rows, _fingerprints, "doc_id long, print long")


def grids(distinct: int, distance: int = DISTANCE) -> list[int]:
    """Bit masks over the embedding, one per grid.

    The segments are cut into blocks; points within Manhattan distance d agree on all but d blocks, so they share
    a cell of at least one grid. Finer blocks mean more grids, so more rows, but fewer random meetings (two bits of a
    segment agree by chance with probability 3/8). The number of blocks is the one at which rows and comparisons
    together cost least: 15 grids up to some 5 million fingerprints, 35 at 10^8, 70 at 10^9. Every number finds the same pairs.
    """

    def cost(blocks: int) -> float:
        grid_count = comb(blocks, distance)
        return grid_count * (ROW_COST + distinct * 0.375 ** (SEGMENTS * (blocks - distance) / blocks))

    blocks = min(range(distance + 2, SEGMENTS + 1), key=cost)
    chosen = list(combinations(range(blocks), blocks - distance))
    bounds = [SEGMENTS * i // blocks for i in range(blocks + 1)]
    masks = [sum(3 << (2 * s) for s in range(bounds[i], bounds[i + 1])) for i in range(blocks)]
    return [sum(masks[i] for i in some) for some in chosen]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _links(distance: int):
    def run(batches: Batches) -> Batches:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            rows = pa.Table.from_batches(held).combine_chunks()
            cell = _cells(rows)
            cut = int(np.flatnonzero(cell == cell[-1])[0]) if len(cell) else 0
            if cut:
                yield _joined(rows["print"].to_numpy()[:cut], cell[:cut], distance)
                held = rows.slice(cut).to_batches()
        if held:
            rows = pa.Table.from_batches(held)
            yield _joined(rows["print"].to_numpy(), _cells(rows), distance)

    return run


def _cells(rows: pa.Table) -> np.ndarray:
    """A running number per cell of sorted rows."""
    new = np.zeros(rows.num_rows, bool)
    for name in CELL:
        values = rows[name].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.cumsum(new)


def _joined(prints: np.ndarray, cell: np.ndarray, distance: int) -> pa.RecordBatch:
    """Edges that join what lies within the distance in each cell: a spanning forest, not all pairs.

    Rows of a cell are sorted by their number of set bits; row i meets row i + 1, i + 2, ... of its cell as long as
    those numbers, then the counts of the eight bytes by Manhattan distance, allow it.
    """
    bits = prints.view(np.uint64)
    embedded = np.bitwise_count(prints.view(np.uint8).reshape(-1, 8)).astype(np.int16)
    total = embedded.sum(1)
    root = np.arange(len(prints))
    near = np.arange(len(prints))
    step = 0
    while len(near):
        step += 1
        near = near[near + step < len(prints)]
        near = near[(cell[near] == cell[near + step]) & (total[near + step] - total[near] <= distance)]
        low = np.abs(embedded[near] - embedded[near + step]).sum(1) <= distance
        left = near[low]
        left = left[np.bitwise_count(bits[left] ^ bits[left + step]) <= distance]
        while len(left := left[root[left] != root[left + step]]):
            a, b = root[left], root[left + step]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
    child = np.flatnonzero(root != np.arange(len(prints)))
    ends = [pa.array(prints[child]), pa.array(prints[root[child]])]
    return pa.RecordBatch.from_arrays(ends, ["a", "b"])


def links(prints: DataFrame, distance: int = DISTANCE, chunk: int = CHUNK, masks: list[int] | None = None) -> DataFrame:
    """Edges (a, b) between distinct fingerprints of column `print` that connect exactly what links within the
    distance connect. Cells above `chunk` rows are cut by hash, and every two parts meet in a task of their own."""
    masks = masks or grids(prints.count(), distance)
    half = F.shiftrightunsigned("print", 1)
    low = F.lit(LOW_BITS)
    point = F.col("print").bitwiseXOR(half).bitwiseAND(low).bitwiseOR(
        F.shiftleft(F.col("print").bitwiseAND(half).bitwiseAND(low), 1)
    )
    cells = F.array(
        *[F.struct(F.lit(i).alias("grid"), F.col("point").bitwiseAND(F.lit(_signed(m))).alias("cell")) for i, m in enumerate(masks)]
    )
    rows = prints.withColumn("point", point).select("print", F.explode(cells).alias("at")).select("print", "at.*")
    crowded = settle(rows.groupBy("grid", "cell").count().filter(F.col("count") > chunk))
    parts = F.ceil(F.coalesce("count", F.lit(1)) / F.lit(chunk)).cast("int")
    placed = (
        rows.join(crowded, ["grid", "cell"], "left")
        .withColumns({"parts": parts, "part": F.pmod(F.xxhash64("print"), parts).cast("int")})
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("grid", "cell", F.least("part", "other").alias("part_a"), F.greatest("part", "other").alias("part_b"), "print")
    )
    ordered = placed.repartition(*CELL).sortWithinPartitions(*CELL, F.bit_count("print"), "print")
    return on_executors(ordered, _links(distance), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, print, fingerprint, component_id) for every input row.

    A null or blank text has fingerprint zero and is linked like any other; repeated rows are kept, a null doc_id is
    kept but never names a component (null if all of a component are null). Other columns are ignored. Equal
    fingerprints are one point of the join, so copies are never paired.
    """
    prints = settle(fingerprints(docs))
    classes = settle(prints.groupBy("print").agg(F.min("doc_id").alias("first")))
    stars = components(links(classes.select("print"), distance))
    rooted = classes.join(stars, F.col("print") == F.col("node"), "left").withColumn("root", F.coalesce("root", "print"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = settle(rooted.join(names, "root").select("print", "component_id"))
    hexed = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return prints.join(named, "print", "left").select("doc_id", "print", hexed, "component_id")


def one_of_each(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """The rows of `docs`, all columns, that stay: of each component the one with the smallest doc_id.

    Rows repeated under one doc_id count as copies. Rows without a doc_id cannot be chosen by it and stay.
    """
    judged = near_duplicates(docs, distance)
    chosen = "_" + "_".join(docs.columns)  # longer than any column's name
    first = settle(judged.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(chosen)).distinct())
    named = docs.join(first, F.col("doc_id").cast("long") == F.col(f"`{chosen}`"), "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.filter(F.col("doc_id").isNull()))
