"""Product codes of vectors: integer k-means for every part of a vector, with LAESA pivots to spare distances.

Some of the first entries of every part's codebook are its pivots. A part's distance to each of them is computed once and written
down beside the vector. In every round the distances between pivots and current entries give, by the triangle inequality, a lower
bound |d(part, pivot) - d(entry, pivot)| for each entry; entries are tried in the order of their greatest bound, and those whose
bound exceeds the best exact distance so far are never evaluated. Bounds are rounded down a little, so the integer result is that of
trying all entries.

Every task adds up the parts it assigns to each entry; sums travel as base-2^32 digits, at most a few thousand numbers for
each task whatever it holds, and are added by Spark, so the driver gets one set of sums for all entries. Components beyond the
range of 64-bit integers are computed with Python's.

Left out are rows whose vector is null or holds null, NaN or infinite components. Ids may repeat or be null: entries start from the
smallest ids, equal ids by their components, null ids last. With fewer kept rows than entries a codebook is as much shorter. The
first of these rows gives the vectors' length; a vector of another length has null as code and error. Where the length is no multiple
of the number of parts, the first parts are not longer than the last. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import Batches, on_executors
from shelfmark.session import settle

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
PIVOTS = 4
#: Sums travel in digits of this base.
DIGIT = 32
#: Sums of squares of components below this leave room for squared differences in 64 bits.
SAFE = 1 << 60
#: Share by which bounds are rounded down: far more than the error of floating-point square roots.
SLACK = 1e-12

#: One codebook for each part: rows of Python integers.
Books = list[list[list[int]]]


def bounds_of(length: int, parts: int) -> list[int]:
    return [length * i // parts for i in range(parts + 1)]


def scaled(x: float) -> int:
    """floor(SCALE * x), exact for every finite double: from 2^53 on doubles are integers."""
    return int(x) * SCALE if abs(x) >= 2.0**53 else int(np.floor(x * SCALE))


def integers(vectors: np.ndarray) -> np.ndarray:
    """Integer components: 64-bit, or Python integers if some do not fit."""
    if not vectors.size or np.abs(vectors).max() < 2.0**48:
        return np.floor(vectors * SCALE).astype(np.int64)
    return np.array([[scaled(x) for x in row] for row in vectors.tolist()], dtype=object).reshape(vectors.shape)


def _alike(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit integers if sums of squared differences fit, else both as Python integers."""
    most = sum(int(np.abs(x).max()) if x.size else 0 for x in (a, b))
    kind = np.int64 if most * most * max(1, a.shape[1]) < SAFE else object
    return a.astype(kind), b.astype(kind)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of a to rows of b."""
    a, b = _alike(a, b)
    return np.stack([((a - row) ** 2).sum(axis=1) for row in b], axis=1) if len(b) else np.empty((len(a), 0), a.dtype)


def roots(distances: np.ndarray) -> np.ndarray:
    if distances.dtype == object:
        return np.array([[float(isqrt(x)) if x < 1 << 2040 else np.inf for x in row] for row in distances.tolist()]).reshape(distances.shape)
    return np.sqrt(distances.astype(np.float64))


def nearest(points: np.ndarray, entries: np.ndarray, to_pivots: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For every point its entry (ties to the lower index) and the exact squared distance; and how many were evaluated."""
    points, entries = _alike(points, entries)
    n = len(points)
    apart = roots(squared(entries, pivots))
    with np.errstate(invalid="ignore"):
        gaps = np.abs(to_pivots[:, None, :] - apart[None, :, :]) - SLACK * (to_pivots[:, None, :] + apart[None, :, :]) - 2
    gaps = np.where(np.isfinite(gaps), np.maximum(gaps, 0), 0).max(axis=2, initial=0)
    order = np.argsort(gaps, axis=1, kind="stable")
    gaps = np.take_along_axis(gaps, order, axis=1)
    best = np.full(n, -1, points.dtype)
    chosen = np.zeros(n, np.int64)
    active, evaluated = np.arange(n), 0
    reach = np.full(n, np.inf)
    for k in range(len(entries)):
        active = active[gaps[active, k] <= reach[active]]  # bounds only grow along the order
        if not len(active):
            break
        entry = order[active, k]
        distance = ((points[active] - entries[entry]) ** 2).sum(axis=1)
        evaluated += len(active)
        now = best[active]
        better = (now < 0) | (distance < now) | ((distance == now) & (entry < chosen[active]))
        at = active[better.astype(bool)]
        best[at], chosen[at] = distance[better.astype(bool)], entry[better.astype(bool)]
        reach[at] = roots(best[at, None])[:, 0] * (1 + SLACK) + 1
    return chosen, best, evaluated


def digits(value: int) -> list[tuple[int, int]]:
    """Signed base-2^DIGIT digits that are not zero, as (place, digit)."""
    sign, value, place, out = (-1 if value < 0 else 1), abs(value), 0, []
    while value:
        if low := value & ((1 << DIGIT) - 1):
            out.append((place, sign * low))
        value, place = value >> DIGIT, place + 1
    return out


@dataclass(frozen=True)
class Codes:
    """What the tasks know: the codebooks, the pivots and where vectors are cut."""

    books: Books
    pivots: Books
    cuts: list[int]

    def vectors(self, batch: pa.RecordBatch) -> np.ndarray:
        flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return integers(flat.reshape(batch.num_rows, self.cuts[-1]))

    def parts(self, whole: np.ndarray, books: Books) -> list[tuple[np.ndarray, np.ndarray]]:
        cut = [whole[:, a:b] for a, b in zip(self.cuts, self.cuts[1:])]
        return [(p, integers_of(book, p.shape[1])) for p, book in zip(cut, books)]

    def measure(self, batches: Batches) -> Batches:
        """Each part's distances to its pivots, beside the vector."""
        for batch in filter(len, batches):
            far = [roots(squared(points, pivots)) for points, pivots in self.parts(self.vectors(batch), self.pivots)]
            flat = np.ascontiguousarray(np.concatenate(far, axis=1))
            column = pa.array([row.tobytes() for row in flat], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "to_pivots"])

    def assigned(self, batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """(points, entry, distance, evaluations) of each part."""
        whole, out, at = self.vectors(batch), [], 0
        far = np.frombuffer(b"".join(batch.column("to_pivots").to_pylist()), np.float64).reshape(batch.num_rows, -1)
        for (points, entries), (_, pivots) in zip(self.parts(whole, self.books), self.parts(whole, self.pivots)):
            out.append((points, *nearest(points, entries, far[:, at : at + len(pivots)], pivots)))
            at += len(pivots)
        return out

    def add(self, batches: Batches) -> Batches:
        """(part, entry, position, place, digit): sums of the parts assigned to each entry, their number at position -1."""
        totals: dict[tuple[int, int, int], int] = {}
        for batch in filter(len, batches):
            for part, (points, entry, _, _) in enumerate(self.assigned(batch)):
                for e in np.unique(entry).tolist():
                    mine = points[entry == e]
                    sums = mine.sum(axis=0) if mine.dtype == object or int(np.abs(mine).max(initial=0)) * len(mine) < SAFE else mine.astype(object).sum(axis=0)
                    for position, value in enumerate([len(mine), *sums.tolist()], -1):
                        totals[part, e, position] = totals.get((part, e, position), 0) + int(value)
        rows = [(*key, place, digit) for key, value in totals.items() for place, digit in digits(value)]
        if rows:
            names = ["part", "entry", "position", "place", "digit"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    def encode(self, batches: Batches) -> Batches:
        """The code, two hex digits a part, the squared distances added up (null beyond 64 bits) and the evaluations."""
        for batch in filter(len, batches):
            found = self.assigned(batch)
            codes = np.stack([entry for _, entry, _, _ in found], axis=1).tolist()
            errors = sum((d.astype(object) for _, _, d, _ in found), np.zeros(batch.num_rows, object)).tolist()
            columns = {
                "row": batch.column("row"),
                "code": pa.array(["".join(f"{e:02x}" for e in row) for row in codes], pa.string()),
                "error": pa.array([int(e) if e < 1 << 63 else None for e in errors], pa.int64()),
                "evaluated": pa.array([sum(n for *_, n in found)] + [0] * (batch.num_rows - 1), pa.int64()),
            }
            yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])


def integers_of(rows: list[list[int]], width: int) -> np.ndarray:
    big = any(abs(x) >= 1 << 62 for row in rows for x in row)
    return np.array(rows, dtype=object if big else np.int64).reshape(len(rows), width)


def _finite(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _updated(books: Books, sums: DataFrame) -> Books:
    """Entries replaced by the floor of their mean; unused ones stay. One row for each number of the codebooks and digit."""
    totals: dict[tuple[int, int, int], int] = {}
    for part, entry, position, place, value in sums.collect():
        key = (part, entry, position)
        totals[key] = totals.get(key, 0) + (int(value) << (DIGIT * place))

    def moved(part: int, entry: int, old: list[int]) -> list[int]:
        count = totals.get((part, entry, -1), 0)
        return [totals.get((part, entry, i), 0) // count for i in range(len(old))] if count else old

    return [[moved(p, e, row) for e, row in enumerate(book)] for p, book in enumerate(books)]


def digest(books: Books) -> str:
    numbers = ",".join(str(x) for book in books for row in book for x in row)
    return hashlib.sha256(numbers.encode()).hexdigest()


def encode(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, Books]:
    """`row` (all columns but the vector), code, error, evaluated of every kept row; and the final codebooks.

    `evaluated` counts exact distances; a batch of rows has them on its first row, so only their sum has a meaning."""
    spark = vectors.sparkSession
    others = [F.col(f"`{c}`") for c in vectors.columns if c != vector_column]
    row = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    order = F.col(f"`{id_column}`") if id_column in vectors.columns else F.lit(None).cast("long")
    named = vectors.select(row.alias("row"), vector.alias("vector"), order.alias("order")).filter(_finite(F.col("vector")))
    first = named.orderBy(F.col("order").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    starts = [[scaled(x) for x in r.vector] for r in first]
    length = len(starts[0]) if starts else 0
    cuts = bounds_of(length, parts)
    books = [[s[a:b] for s in starts if len(s) == length] for a, b in zip(cuts, cuts[1:])]
    fixed = Codes(books, [book[:pivots] for book in books], cuts)
    fits = F.size("vector") == length
    kind = T.StructType([*named.select("row", "vector").schema.fields, T.StructField("to_pivots", T.BinaryType())])
    measured = settle(on_executors(named.filter(fits).select("row", "vector"), fixed.measure, kind))
    schema = "part long, entry long, position long, place long, digit long"
    for _ in range(rounds):
        sums = on_executors(measured.select("vector", "to_pivots"), Codes(books, fixed.pivots, cuts).add, schema)
        digit = F.sum(F.col("digit").cast("decimal(38,0)")).alias("digit")
        books = _updated(books, sums.groupBy("part", "entry", "position", "place").agg(digit))
    added = {"code": T.StringType(), "error": T.LongType(), "evaluated": T.LongType()}
    kind = T.StructType([measured.schema["row"], *(T.StructField(c, t) for c, t in added.items())])
    coded = on_executors(measured, Codes(books, fixed.pivots, cuts).encode, kind)
    rest = named.filter(~fits).select("row")
    return coded.unionByName(rest, allowMissingColumns=True), books


def report(vectors: DataFrame) -> DataFrame:
    """The contract of op12. A sum of errors beyond 64 bits is null."""
    coded, books = encode(vectors.select("vec_id", "embedding", "label"))
    rows = settle(coded.select("row.vec_id", "row.label", "code", "error"))
    total = F.sum(F.col("error").cast("decimal(38,0)")).alias("total")
    sums = settle(rows.groupBy("label").agg(total).select(F.col("label").alias("same"), F.expr("try_cast(total AS long)").alias("label_error")))
    # The sums are written down, so that a label with many rows is split when the rows are dealt out by label.
    return rows.join(sums, F.col("label").eqNullSafe(F.col("same"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
