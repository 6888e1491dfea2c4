"""Contaminated words and items against plain code, broadcast and shuffled."""

import hashlib
import re

import duckdb
import pytest

from shelfmark.llm import contamination
from shelfmark.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def slow_windows(items, size=10):
    windows = {}
    for item, text in items:
        words = slow_words(text)
        n = min(size, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add("" if item is None else str(item))
    return windows


def slow_row(text, windows):
    words = slow_words(text)
    hit, items = set(), set()
    for n in {len(w) for w in windows}:
        for i in range(len(words) - n + 1):
            if found := windows.get(tuple(words[i : i + n])):
                hit |= set(range(i, i + n))
                items |= found
    return len(words), sorted(hit), sorted(items)


def slow_report(text, windows):
    n, hit, items = slow_row(text, windows)
    return n, len(hit), len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    folder = f"/root/testdata/{sf}"
    windows = slow_windows(duckdb.sql(f"SELECT item_id, text FROM '{folder}/benchmark.parquet'").fetchall())
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_decontamination"](spark, folder).collect()}
    assert found == {i: slow_report(text, windows) for i, text in docs}
    assert any(r[-1] for r in found.values()) and not all(r[-1] for r in found.values())


LONG = "the quick brown fox jumps over the lazy dog near a river bank at dawn"
ITEMS = [
    (1, LONG), (1, "one more text of item one"), (2, "Two  WORDS"), (3, "single"), (4, ""), (5, None), (None, "nobody owns this text"), (None, "nor this"),
    (6, "a a a a a a a a a a a a"), (7, "ÉTÉ là-bas"), (8, "..."), (9, LONG), (10, "x y x y x y x y x y x y x"),
]
TEXTS = [
    None, "", "single", "SINGLE, single; Single", "two. words", "two", LONG.upper().replace(" ", "--"), LONG[:30], "start " + LONG + " end " + LONG, LONG[4:],
    "a a a a a a a a a", "a " * 30, "x y " * 9, "y x y x", "ÉTÉ LÀ bas", "été là bas", "Nobody owns this text. Nor this!", "one more text of item one", "one more text of item",
    "word " * 70_000 + LONG, LONG[:-1], "the quick brown fox jumps over a lazy dog near a river bank at dawn", "\x00\ttwo\nwords\x7f",
]


@pytest.mark.parametrize("most_bytes", [contamination.MOST_BYTES, 0])
def test_odd_rows(spark, most_bytes):
    """Short items, repeated and null ids, repeated words, long texts, clashing column names; both ways to join."""
    rows = [(i % 20, t, "k", {"a": 1}, 5, 6) for i, t in enumerate(TEXTS)] + [(None, TEXTS[6], "k", None, 7, 8)] * 2
    docs = spark.createDataFrame(rows, "doc_id int, text string, words string, key map<string,int>, `a.b` int, id long")
    items = spark.createDataFrame([(i, t, "w") for i, t in ITEMS], "item_id long, text string, window string")
    windows = slow_windows(ITEMS)
    found = contamination.decontaminate(docs, items, most_bytes=most_bytes).collect()
    got = sorted((str(r.row.doc_id), r.row["a.b"], r.n_words, [p for s in r.spans for p in range(s.start, s.end)], r["items"]) for r in found)
    want = sorted((str(r[0]), r[4], *(slow_row(r[1], windows))) for r in rows)
    assert got == want
    assert all(a.end < b.start for r in found for a, b in zip(r.spans, r.spans[1:]))


@pytest.mark.parametrize("most_bytes", [contamination.MOST_BYTES, 0])
def test_empty_tables(spark, most_bytes):
    docs, items = "doc_id long, text string", "item_id long, text string"
    some, none = spark.createDataFrame([(1, "a b c")], docs), spark.createDataFrame([], docs)
    there, nothing = spark.createDataFrame([(1, "b")], items), spark.createDataFrame([(2, None)], items)
    for d, b in ((none, there), (none, nothing), (some, nothing), (some, nothing.limit(0))):
        found = contamination.decontaminate(d, b, most_bytes=most_bytes).collect()
        assert [(r.n_words, r.spans, r["items"]) for r in found] == [(3, [], [])] * d.count()
    assert [r.spans for r in contamination.decontaminate(some, there, most_bytes=most_bytes).collect()] == [[(1, 2)]]


def test_other_sizes(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "c d x e f")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "z c d e"), (2, "e f")], "item_id long, text string")
    for size, shingle in ((2, 3), (3, 2), (1, 1), (4, 1)):
        windows = slow_windows([(1, "z c d e"), (2, "e f")], size)
        found = contamination.decontaminate(docs, items, size=size, shingle=shingle).collect()
        got = sorted((r.row.doc_id, r.n_words, [p for s in r.spans for p in range(s.start, s.end)], r["items"]) for r in found)
        assert got == [(1, *slow_row("a b c d e f g", windows)), (2, *slow_row("c d x e f", windows))]


def test_main_path_is_native(spark, monkeypatch):
    """No Python in the plans, and texts are not shuffled where the windows are broadcast."""
    plans, found = [], contamination._found
    monkeypatch.setattr(contamination, "_found", lambda *a: plans.append(found(*a)) or plans[-1])
    result = QUERIES["op11_decontamination"](spark, "/root/testdata/sf0.001")
    text = [p._jdf.queryExecution().executedPlan().toString() for p in (*plans, result)]
    assert not any(re.search("Python|Pandas|Arrow", t) for t in text)
    assert "Exchange hashpartitioning" not in text[0] and "BroadcastHashJoin" in text[0]
