"""Exact repeats against brute force."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import repeats
from shelfmark.llm.queries import QUERIES


def slow(texts, length):
    starts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if starts[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return out


def test_query_against_brute_force(spark, small_documents):
    texts = [(t or "").encode() for t in small_documents["text"]]
    rows = QUERIES["op10_suffix_dedup"](spark, small_documents["dir"]).collect()
    assert sorted(map(tuple, rows)) == sorted((i, *r) for i, r in zip(small_documents["doc_id"], slow(texts, 200)))


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefghij é"])
def test_edited_copies(spark, letters):
    """Periodic, repetitive and ordinary texts with edits at every distance."""
    random.seed(len(letters))
    base = "".join(random.choices(letters, k=400))
    texts = [None, "", "a" * 39, base, base, base[100:300] * 2]
    for _ in range(40):
        a, b = sorted(random.sample(range(400), 2))
        noise = "".join(random.choices(letters, k=random.randint(0, 60)))
        texts.append(noise + base[a:b] + random.choice(letters) + base[: random.randint(0, 90)])
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, key int").repartition(3)
    rows = {r[0]: tuple(r)[1:] for r in repeats.report(docs, 40).collect()}
    assert [rows[i] for i in range(len(texts))] == slow([(t or "").encode() for t in texts], 40)


def test_long_text(spark):
    """Longer than one hashed piece; the repeat crosses the cut."""
    random.seed(3)
    text = "".join(random.choices("abcdefgh ", k=repeats.STEP + 5000))
    texts = [text, "x" * 300 + text[repeats.STEP - 700 : repeats.STEP + 900] + "y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in repeats.remove_repeats(docs).select("row.doc_id", "spans", "n_bytes").collect()}
    assert [tuple(s) for s in rows[0].spans] == [(repeats.STEP - 700, repeats.STEP + 900)]
    assert [tuple(s) for s in rows[1].spans] == [(0, 1900)]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "z" * 300, 1), (None, None, 2)], "doc_id long, text string, spans int")
    rows = sorted(repeats.remove_repeats(docs).select("row.spans", "n_bytes", "kept").collect())
    assert [tuple(r) for r in rows] == [(1, 300, b""), (2, 0, b"")]
    assert repeats.report(docs.filter(F.lit(False))).count() == 0
