"""Quality rules against a plain count, and the divergence on clean and junk documents."""

import math
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import quality_rules
from shelfmark.llm.queries import QUERIES

ALPHABETS = {"large": "abcdefghijklm", "rare": "αβγδεζηθικλμν", "few": "бвгджзиклмнпр"}


def slow(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeat = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    base = (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeat))
    return (*base, len(words) < 50 or 100 * len(repeat) > 50 * len(words))


def slow_distance(p, q):
    p, q = ([x / sum(h) for x in h] for h in (p, q))
    parts = [sum(a * math.log2(2 * a / (a + b)) for a, b in zip(*pair) if a) for pair in ((p, q), (q, p))]
    return math.sqrt(sum(parts) / 2)


def test_query_against_plain_count(spark, more_documents):
    rows = {r.doc_id: r for r in QUERIES["op6_quality_rules"](spark, more_documents["dir"]).collect()}
    texts = dict(zip(more_documents["doc_id"], more_documents["text"]))
    langs = dict(zip(more_documents["doc_id"], more_documents["lang"]))
    plain = {i: re.sub(r"[!-/:-@\[-`{-~]", "", "".join(c.lower() if c.isascii() else c for c in t)) for i, t in texts.items()}
    words = {lang: Counter() for lang in set(langs.values())}
    for i, t in plain.items():
        words[langs[i]].update(re.findall(r"[^\x20\x09-\x0D]+", t))
    common = {lang: sorted(c, key=lambda w: (-c[w], w.encode()))[:50] for lang, c in words.items()}
    for i, t in texts.items():
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == slow(t)
        if r.n_words >= 200:
            own, all_words = Counter(re.findall(r"[^\x20\x09-\x0D]+", plain[i])), words[langs[i]]
            bins = [[c[w] for w in common[langs[i]]] for c in (own, all_words)]
            bins = [[*b, c.total() - sum(b)] for b, c in zip(bins, (own, all_words))]
            assert r.js_words == pytest.approx(slow_distance(*bins), abs=1e-6)
        else:
            assert r.js_words is None
        assert r.kept == (not r.base_failed and (r.js_chars or 0) <= 0.32 and (r.js_words or 0) <= 0.33)
    good = duckdb.sql(f"SELECT doc_id FROM '{more_documents['dir']}/labels.parquet' WHERE quality = 1").fetchall()
    assert all(rows[i].kept or rows[i].base_failed for (i,) in good)
    assert any(not r.kept and not r.base_failed for r in rows.values())


def test_distance():
    import numpy as np

    assert quality_rules.distance(np.array([1.0, 0]), np.array([0, 2.0])) == 1
    assert quality_rules.distance(np.array([1.0, 3]), np.array([2.0, 6])) == 0


@pytest.mark.parametrize("text", ["", "a", "a b", "a b c", "a b c a b c", "a a a a", "x " * 200_000 + "y"])
def test_repeats(text):
    assert quality_rules.repeated_words(text.encode().split()) == slow(text)[4]


def test_many_different_words():
    words = [b"%d" % (i % 2_500_000) for i in range(2_500_010)]
    assert quality_rules.repeated_words(words) == 20


def test_odd_rows(spark):
    text = "the cat sat on the mat and looked at a bird\r\n" * 6
    rows = [(1, text, None, 1), (1, text, None, 1), (None, None, "en", 2), (3, "", "xx", 3), (4, "\n\n \n", "en", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept int")
    found = quality_rules.judge(docs).collect()
    assert len(found) == 5 and not any(r.kept for r in found)
    assert quality_rules.judge(docs.filter(F.lit(False))).count() == 0
    assert quality_rules.judge(docs.filter("doc_id = 3")).first().js_chars is None


def test_a_rare_language_is_judged_by_itself_or_not_at_all(spark, tmp_path):
    """Clean texts of a rare language stay, however large others grow; below the guard there is no distance."""
    from compare import compare, connect

    pick = random.Random(3)
    vocabulary = {lang: ["".join(pick.choices(letters, k=pick.randint(2, 9))) for _ in range(400)] for lang, letters in ALPHABETS.items()}
    say = lambda lang: " ".join(pick.choices(vocabulary[lang], [1 / (i + 1) for i in range(400)], k=300)) + "."
    counts = {"large": 300, "rare": 20, None: 18, "few": 2}
    rows = [(i, say(lang or "rare"), lang) for i, lang in enumerate(lang for lang, n in counts.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    small = {r.doc_id: r for r in quality_rules.judge(docs.filter("lang IS DISTINCT FROM 'large'")).collect()}
    assert all(found[i].kept for i, _, _ in rows) and all(found[i] == r for i, r in small.items()) and len(small) == 40
    assert all((found[i].js_chars is None) == (found[i].js_words is None) == (lang == "few") for i, _, lang in rows)
    wrong = spark.createDataFrame([(-1, say("rare"), "large")], docs.schema)
    assert not next(r for r in quality_rules.judge(docs.unionByName(wrong)).collect() if r.doc_id == -1).kept
    docs.unionByName(wrong).toPandas().to_parquet(tmp_path / "documents.parquet")
    assert compare(connect(str(tmp_path)), "op6_quality_rules", QUERIES["op6_quality_rules"](spark, str(tmp_path))) == ""
