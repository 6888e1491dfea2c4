"""Codes, errors and codebooks against plain Python integers."""

import hashlib
import random
from fractions import Fraction
from math import floor, inf, nan

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import vector_codes
from shelfmark.llm.queries import QUERIES


def kept(vector):
    return vector is not None and all(x is not None and x == x and abs(x) != inf for x in vector)


def slow_codes(rows, parts=8, entries=16, rounds=6):
    """rows: (id, vector, label) -> codes and errors by row, and the codebooks."""
    whole = {i: [floor(Fraction(x) * 4096) for x in r[1]] for i, r in enumerate(rows) if kept(r[1])}
    first = sorted(whole, key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:entries]
    length = len(whole[first[0]]) if first else 0
    cuts = [length * p // parts for p in range(parts + 1)]
    whole = {i: v for i, v in whole.items() if len(v) == length}
    cut = {i: [v[a:b] for a, b in zip(cuts, cuts[1:])] for i, v in whole.items()}
    books = [[cut[i][p] for i in first if i in cut] for p in range(parts)]

    def assign(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for i in cut:
                groups.setdefault(assign(p, cut[i][p])[1], []).append(cut[i][p])
            books[p] = [[sum(c) // len(groups[e]) for c in zip(*groups[e])] if e in groups else old for e, old in enumerate(books[p])]
    found = {i: [assign(p, cut[i][p]) for p in range(parts)] for i in cut}
    return {i: ("".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f)) for i, f in found.items()}, books


def slow_digest(books):
    return hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def test_query(spark):
    rows = duckdb.sql("SELECT vec_id, embedding, label FROM '/root/testdata/sf0.001/embeddings.parquet'").fetchall()
    codes, books = slow_codes(rows)
    labels = {}
    for i, r in enumerate(rows):
        labels[r[2]] = labels.get(r[2], 0) + codes[i][1]
    want = sorted((r[0], *codes[i], labels[r[2]], slow_digest(books)) for i, r in enumerate(rows))
    assert sorted(map(tuple, QUERIES["op12_vector_codes"](spark, "/root/testdata/sf0.001").collect())) == want


SCHEMA = "vec_id long, embedding array<double>, label string, code string, vector int, `a.b` int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, n) for n, r in enumerate(rows)], SCHEMA)


def check(spark, rows, **settings):
    coded, books = vector_codes.encode(frame(spark, rows), **settings)
    codes, slow = slow_codes(rows, **{k: v for k, v in settings.items() if k != "pivots"})
    got = {r.row["a.b"]: (r.code, r.error) for r in coded.collect()}
    none = {i: (None, None) for i, r in enumerate(rows) if kept(r[1]) and i not in codes}
    assert got == {i: (c, e if e < 2**63 else None) for i, (c, e) in codes.items()} | none
    assert books == slow


def test_odd_rows(spark):
    """Nulls, infinities, ties, repeated ids and vectors, other lengths, numbers beyond 64 bits."""
    r = random.Random(1)
    plain = [(r.choice([None, 1, 2, r.randrange(99)]), [r.choice([0.0, -0.5, r.uniform(-1, 1)]) for _ in range(11)], None) for _ in range(60)]
    odd = [(5, None, "a"), (6, [1.0] * 10 + [None], "a"), (0, [nan] * 11, "a"), (0, [0.0] * 10 + [-inf], "a"), (7, [1.0], "a"), (8, [], "b")]
    check(spark, plain + odd + plain[:9])
    check(spark, [(n, [r.uniform(-1, 1) * 10.0 ** r.randrange(300) for _ in range(9)], "a") for n in range(30)])
    check(spark, [(n, [r.uniform(-1, 1) * 10.0 ** r.randrange(7) for _ in range(9)], "a") for n in range(30)], rounds=2)
    check(spark, [(n, [r.gauss(0, 1) for _ in range(6)], "a") for n in range(200)], parts=2, entries=40, pivots=7, rounds=3)


def test_few_rows(spark):
    check(spark, [(3, [1.0, 2.0], None)] * 2)
    check(spark, [(3, [], None)] * 3)
    check(spark, [])
    check(spark, [(1, None, None)])


def test_labels_and_empty(spark):
    rows = [(n, [n * 0.1] * 8, None if n % 3 else "a") for n in range(40)] + [(50, [1e300] * 8, "b"), (51, [-1e300] * 8, "b")]
    codes, _ = slow_codes(rows)
    found = vector_codes.report(frame(spark, rows)).collect()
    sums = {n: sum(codes[i][1] for i, r in enumerate(rows) if r[2] == n) for n in (None, "a")}
    assert {r.vec_id: r.label_error for r in found if r.vec_id < 50} == {r[0]: sums[r[2]] for r in rows[:40]}
    assert vector_codes.report(frame(spark, [])).collect() == []


def test_pivots_spare_distances(spark):
    """Bounds prune most exact distances of clustered vectors, and far from all of them are evaluated."""
    r = random.Random(2)
    centres = [[r.gauss(0, 1) for _ in range(16)] for _ in range(16)]
    rows = [(n, [x + r.gauss(0, 0.02) for x in centres[n % 16]], None) for n in range(800)]
    coded, _ = vector_codes.encode(frame(spark, rows), pivots=4)
    assert coded.agg(F.sum("evaluated")).first()[0] < 0.4 * 800 * 8 * 16


@pytest.mark.parametrize("scale", [1, 1e6, 1e30, 1e200])
def test_nearest(scale):
    rng = np.random.default_rng(3)
    points, entries = (vector_codes.integers(rng.normal(size=(n, 5)) * scale) for n in (300, 16))
    entries[7] = entries[3]
    far = vector_codes.roots(vector_codes.squared(points, entries[:4]))
    chosen, best, evaluated = vector_codes.nearest(points, entries, far, entries[:4])
    every = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, e)) for e in entries] for p in points]
    assert chosen.tolist() == [row.index(min(row)) for row in every] and [int(x) for x in best] == [min(row) for row in every]
    assert evaluated < 300 * 16
