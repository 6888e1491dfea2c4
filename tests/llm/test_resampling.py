"""Importance resampling: plain counts, exact selection, held-out accuracy."""

import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import resampling
from shelfmark.llm.queries import QUERIES


def slow_tokens(text):
    return re.findall(rb"[0-9A-Za-z_\x80-\xff]+|[^0-9A-Za-z_\x80-\xff\x20\x09-\x0D]+", text)


def slow_ngrams(text):
    def hashed(token):
        return int(resampling._tokens(np.frombuffer(token, np.uint8))[1][0])

    hashes = [hashed(t) for t in slow_tokens(text)]
    pairs = [int(resampling._mix(np.array([(a * resampling.BASE + b) % 2**64], np.uint64))[0]) for a, b in zip(hashes, hashes[1:])]
    return [h % resampling.BUCKETS for h in hashes + pairs]


@pytest.mark.parametrize("text", ["", " ", "a", "Don't stop!! \nnow, é_1 a a", "!!", "x" * 99])
def test_ngrams(text):
    found = resampling.ngrams(np.frombuffer(text.encode(), np.uint8))
    assert np.concatenate(found).tolist() == slow_ngrams(text.encode())


def test_query_against_plain_weights(spark, small_documents):
    rows = {r.doc_id: r for r in QUERIES["op8_resampling"](spark, small_documents["dir"]).collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality, toxic FROM '{small_documents['dir']}/labels.parquet'").fetchall()
    clean = [i for i, q, t in labels if q == 1 and not t]
    grams = {i: slow_ngrams((t or "").encode()) for i, t in zip(small_documents["doc_id"], small_documents["text"])}
    counts = np.ones((2, resampling.BUCKETS))
    for i, g in grams.items():
        np.add.at(counts[0], g, 1)
    for i in sorted(clean)[::2]:
        np.add.at(counts[1], grams[i], 1)
    raw, target = np.log(counts / counts.sum(1, keepdims=True))
    mean = {i: (target - raw)[g].sum() / (len(g) + 10) for i, g in grams.items()}
    for i, g in grams.items():
        assert rows[i].n_ngrams == len(g) and rows[i].mean_weight == pytest.approx(mean[i])
    threshold = min(sorted(mean[i] for i in clean)[int(len(clean) * resampling.LOST)], 0) - resampling.MARGIN
    assert sum(r.kept for r in rows.values()) == sum(m >= threshold for m in mean.values())
    kept = [r.key for r in rows.values() if r.kept]
    assert min(kept) > max(r.key for r in rows.values() if not r.kept)


def test_held_out_accuracy(spark, more_documents):
    """Fitted on half of the labels, judged on the other."""
    docs = spark.read.parquet(f"{more_documents['dir']}/documents.parquet")
    labels = spark.read.parquet(f"{more_documents['dir']}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    judged = resampling.judge(docs, labels.filter(half)).join(labels.filter(~half), "doc_id").collect()
    good = [r.kept for r in judged if r.quality == 1 and not r.toxic]
    junk = [r.kept for r in judged if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(junk) <= 0.3 * len(junk)


def test_held_out_toxic_and_junk(spark):
    """Fitted on half of the labels, judged on the other, each kind by itself."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    judged = resampling.judge(docs, labels.filter(half)).join(labels.filter(~half), "doc_id").collect()
    good, toxic, junk = (
        [r.kept for r in judged if (r.quality, r.toxic) == kind] for kind in ((1, 0), (1, 1), (0, 0))
    )
    assert min(len(good), len(toxic), len(junk)) > 100
    assert sum(good) >= 0.99 * len(good) and sum(toxic) <= 0.2 * len(toxic) and sum(junk) <= 0.1 * len(junk)


def test_a_few_toxic_words_in_a_long_text(spark):
    random.seed(5)
    words = [f"w{i}" for i in range(300)]

    def text(n, *more):
        chosen = random.choices(words, k=n)
        return " ".join([*chosen[: n // 2], *more, *chosen[n // 2 :]])

    rows = [(i, text(150, *(["vile", "rotten"] if i % 5 == 0 else []))) for i in range(400)]
    rows += [(1000, text(5000, "vile", "Rotten", "vile")), (1001, text(5000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in resampling.judge(docs, labels).collect()}
    assert all(kept[i] == (i % 5 != 0) for i in range(300, 400)) and not kept[1000] and kept[1001]
    assert {r.doc_id for r in resampling.keep(docs, labels).collect()} == {i for i, k in kept.items() if k}
    few = labels.filter("doc_id < 90")
    assert all(r.kept for r in resampling.judge(docs, few).collect())


@pytest.mark.parametrize("k", [1, 2, 500, 999, 1000])
def test_kth_largest(spark, k):
    random.seed(k)
    values = [random.choice([random.random(), random.gauss(0, 1e6), 3.0, -math.inf if k == 0 else 7.5]) for _ in range(1000)]
    found = resampling.kth_largest(spark.createDataFrame([(v,) for v in values], "x double"), "x", k, bins=8)
    assert found == sorted(values, reverse=True)[k - 1]


def test_odd_rows(spark):
    rows = [(1, "good words here", 1), (1, "good words here", 1), (None, None, 2), (3, "", 3), (4, "y" * 2_000_000, None)]
    rows += [(5, "a b " * 400_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, None), (None, 1, 0), (4, None, None), (9, 1, 0)], "doc_id long, quality int, toxic int")
    judged = resampling.judge(docs, labels).collect()
    assert len(judged) == 6 and {r.n_ngrams for r in judged if r.doc_id in (None, 3)} == {0}
    assert [r.n_ngrams for r in judged if r.doc_id == 1] == [5, 5]
    assert resampling.keep(docs, labels.filter(F.lit(False))).count() == 6
    assert set(resampling.keep(docs, labels).columns) == {"doc_id", "text", "kept"}
    assert resampling.judge(docs.filter(F.lit(False)), labels).count() == 0


def test_labels_beyond_the_bound(spark):
    """Of many labels those of least hash are used, whether or not a bound on the hash comes first; cuts are named."""
    labels = spark.range(5000).selectExpr("id as doc_id", "cast(id % 3 > 0 as int) quality", "cast(id % 7 = 0 as int) toxic")
    order = [r.doc_id for r in labels.orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    kinds = {"toxic": lambda i: i % 7 == 0, "junk": lambda i: i % 7 and i % 3 == 0, "clean": lambda i: i % 7 and i % 3}
    for bound in (40, 600, 10_000):
        found = resampling._chosen(labels, bound)
        assert {k: found[k].tolist() for k in kinds} == {k: sorted([i for i in order if f(i)][:bound]) for k, f in kinds.items()}


def test_cuts_are_named(spark):
    docs = spark.createDataFrame([(i, "some plain words here") for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(10)], "doc_id long, quality int, toxic int")
    assert {r.cuts for r in resampling.judge(docs, labels).collect()} == {""}
