"""Order MinHash against a plain one, and its behaviour under edits."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import order_minhash as omh
from shelfmark.llm.queries import QUERIES


def slow_signature(text):
    k, seen, ranked = min(omh.K, len(text)), {}, []
    for i in range(len(text) - k + 1 if text else 0):
        kmer = int(omh._kmers(np.frombuffer(text[i : i + k], np.uint8))[0])
        seen[kmer] = seen.get(kmer, -1) + 1
        rank = int(omh._mix(np.array([(kmer * omh.BASE + seen[kmer] * omh.OTHER) % 2**64], np.uint64))[0])
        ranked.append((rank, i, kmer))
    out = []
    for b in range(omh.BINS):
        chosen = sorted(r for r in ranked if r[0] >> 58 == b)[: omh.SELECTED]
        value = 0
        for _, _, kmer in sorted(chosen, key=lambda r: r[1]):
            value = int(omh._mix(np.array([(value * omh.BASE + kmer + 1) % 2**64], np.uint64))[0])
        out.append(max(1, value >> 48) if chosen else 0)
    return out


@pytest.mark.parametrize("n", [0, 1, 5, 12, 13, 60, 700, 9000])
@pytest.mark.parametrize("letters", ["a", "ab", "abcdefgh é"])
def test_signature(n, letters):
    random.seed(n)
    text = "".join(random.choices(letters, k=n)).encode()
    assert omh.signature(text).tolist() == slow_signature(text)


def test_likeness_follows_edits():
    random.seed(5)
    words = ["".join(random.choices("abcdefghij", k=random.randint(2, 9))) for _ in range(3000)]
    text = omh.signature(" ".join(words).encode())
    few, many = (words[:] for _ in range(2))
    for i in random.sample(range(3000), 20):
        few[i] = "changed"
    for i in random.sample(range(3000), 1000):
        many[i] = "changed"
    swapped = words[1500:] + words[:1500]
    near = [omh.likeness(text, omh.signature(" ".join(w).encode())) for w in (words, few, many, words[::-1])]
    assert near[0] == 1 and 0.8 < near[1] < 1 and near[2] < 0.4 and near[3] < 0.1
    assert omh.likeness(text, omh.signature(" ".join(swapped).encode())) < 0.8
    assert omh.likeness(omh.signature(b""), omh.signature(b"")) == 1


def expected(ids, texts):
    out = []
    signed = [omh.signature((t or "").encode()) for t in texts]
    for i, (doc_id, text) in enumerate(zip(ids, texts)):
        text, after = text or "", texts[(i + 1) % len(texts)] or ""
        edited = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
        other = omh.signature(edited.encode())
        near = omh.likeness(signed[i], other), omh.likeness(signed[i], signed[(i + 1) % len(ids)])
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out.append((doc_id, len(text), digest, omh._hexed(signed[i]), omh._hexed(other), *near))
    return out


def test_query_against_a_loop(spark, small_documents):
    rows = sorted(map(tuple, QUERIES["op9_order_minhash"](spark, small_documents["dir"]).collect()))
    assert rows == expected(small_documents["doc_id"], small_documents["text"])


def test_odd_rows(spark):
    rows = [(None, "é" * 50, "x"), (3, None, "x"), (4, "", "x"), (7, "one two three four", "x"), (9, "z" * 3_000_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string").repartition(4)
    found = sorted(map(tuple, omh.compare_with_edits(docs).collect()), key=lambda r: r[0] or 0)
    assert found == expected(*zip(*(r[:2] for r in rows)))
    one = docs.filter("doc_id = 7")
    assert [tuple(r) for r in omh.compare_with_edits(one).collect()] == expected([7], ["one two three four"])
    same = one.unionByName(one).unionByName(one)
    assert omh.compare_with_edits(same).count() == 3 == omh.signatures(same).count()
    assert omh.compare_with_edits(docs.filter(F.lit(False))).count() == 0
