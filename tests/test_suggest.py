"""The stored name index against plain code: prefixes by blocks of the dictionary, pieces by their frequency, wildcards alone."""

import random
import re

import pytest

from shelfmark import schemas as S
from shelfmark.operators import suggest

PRODUCT = "id string, name string, description string, price decimal(10,2)"


def catalog(spark, names):
    return spark.createDataFrame([(str(i), name, "d", None) for i, name in enumerate(names)], PRODUCT)


def asked(spark, prefixes):
    return suggest.clean(spark.createDataFrame(list(enumerate(prefixes)), S.SUGGEST_REQUEST))


def test_prefixes_by_blocks(spark, monkeypatch):
    """The first twenty words of every prefix, at the ends of blocks, before the first and after the last word."""
    monkeypatch.setattr(suggest, "BLOCK", suggest.EXPANSIONS)
    r = random.Random(5)
    words = sorted({"".join(r.choice("abz") for _ in range(r.randrange(1, 7))) for _ in range(700)} | {"çédille", "œuf", "0", "zzzzzzzz"})
    names = suggest.Names.build(catalog(spark, words))
    folded = [row.term for row in names.terms(suggest.FOLDED).orderBy("number").collect()]
    assert folded == sorted(folded) and names.read("heads").count() == -(-len(folded) // suggest.BLOCK) > 10
    prefixes = sorted({w[:n] for w in words for n in (1, 2, 3)}) + ["", "!", "zzzzzzzzz", "bb", "aaaaaaa", "ab0", "ç", "~"]
    found = {}
    for row in names.first_terms(spark.createDataFrame([(p,) for p in prefixes], "last string")).collect():
        found.setdefault(row["last"], []).append(row.term)
    want = {p: [w for w in folded if w.startswith(p)][: suggest.EXPANSIONS] for p in prefixes}
    assert {p: sorted(t) for p, t in found.items()} == {p: t for p, t in want.items() if t}


def test_dictionary_numbers_terms(spark):
    names = suggest.Names.build(catalog(spark, ["Red Lamp", "red  chair", "Lamp", None, ""]))
    assert [tuple(r) for r in names.terms(suggest.FOLDED).orderBy("number").collect()] == [("chair", 1, 1, 0), ("lamp", 2, 2, 0), ("red", 2, 3, 0)]


def slow_contains(names, prefix):
    pattern = re.compile("(?s:.*" + "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in prefix) + ".*)")
    hits = []
    for i, name in enumerate(names):
        words = [w.lower() for w in re.findall(r"\w+", name)]
        score = any(pattern.fullmatch(w) for w in words) + any(pattern.fullmatch(w[:20]) for w in words if len(w) > 1)
        if score:
            hits.append((-score, name, str(i)))
    return [(i, float(-s)) for s, _, i in sorted(hits)[:10]]


PREFIXES = ["common", "rare7", "n7", "x", "mon12", "*", "??", "?", "***?????????", "c*7", "?are", "ommo?1*2", "zq", "mo n", "*q*"]


def test_contains_by_the_rarest_piece(spark):
    """Every term holds the pieces of "common", few those of "rare7": joined are the terms of the rarest piece only."""
    items = [f"common{i} thing{i % 7}" for i in range(300)] + ["rare7common end", "a bb", "x"]
    names = suggest.Names.build(catalog(spark, items))
    assert names.read("grams").filter("length(gram) = 0 or length(gram) > 3").isEmpty()
    found = {}
    for row in suggest.by_contains(asked(spark, PREFIXES), names).orderBy("prefix_id", "rank").collect():
        found.setdefault(PREFIXES[row["prefix_id"]], []).append((row["id"], row["score"]))
    assert found == {p: hits for p in PREFIXES if (hits := slow_contains(items, p))}


def test_a_piece_in_all_terms_is_not_joined(spark, monkeypatch):
    """Of "rare7common" a piece is joined that one term holds, though others are in every term."""
    names = suggest.Names.build(catalog(spark, [f"common{i}" for i in range(400)] + ["rare7common"]))
    joined, join = [], suggest.skew.join
    monkeypatch.setattr(suggest.skew, "join", lambda rows, lookup, on, how="inner": joined.append((on, join(rows, lookup, on, how))) or joined[-1][1])
    assert suggest.by_contains(asked(spark, ["are7common"]), names).count() == 1
    assert [df.count() for on, df in joined if on == ["gram"]][-1] == 1


def test_empty_catalog(spark):
    names = suggest.Names.build(catalog(spark, []))
    for answer in (suggest.by_prefix, suggest.by_contains, suggest.by_fuzzy):
        assert answer(asked(spark, ["a", "*", "red lamp"]), names).isEmpty()


@pytest.mark.parametrize("answer", [suggest.by_prefix, suggest.by_contains, suggest.by_fuzzy])
def test_stages_read_the_index_only(spark, answer):
    """No stage takes the names of the catalog apart."""
    names = suggest.Names.build(catalog(spark, ["red lamp", "blue lamp"]))
    plan = answer(asked(spark, ["la", "ed", "lmap"]), names)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all(lower(name" not in plan
    assert "NestedLoop" not in plan
