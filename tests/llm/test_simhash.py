"""SimHash near-duplicates against brute force."""

import random
import re
from math import comb

import pytest
import xxhash
from pyspark.sql import functions as F

from shelfmark.llm import simhash
from shelfmark.llm.queries import QUERIES


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    group = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4 and group[i] != group[j]:
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    return group


def test_query_against_brute_force(spark, small_documents):
    prints = [slow_print(t) for t in small_documents["text"]]
    groups = slow_components(prints)
    ids = small_documents["doc_id"]
    first = {g: min(i for i, h in zip(ids, groups) if h == g) for g in groups}
    rows = QUERIES["op3_simhash"](spark, small_documents["dir"]).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in rows) == sorted(
        (i, f"{p:016x}", first[g]) for i, p, g in zip(ids, prints, groups)
    )


@pytest.mark.parametrize("blocks", [6, 7, 9])
@pytest.mark.parametrize("chunk", [4, 1024])
def test_links_of_crowded_cells(spark, monkeypatch, blocks, chunk):
    """Chains and crowds of fingerprints; every number of blocks and cut cells join the same."""
    random.seed(blocks)
    prints = {random.getrandbits(64) for _ in range(150)}
    for seed in list(prints)[:4]:
        for _ in range(60):
            seed ^= sum(1 << b for b in random.sample(range(64), random.randint(1, 5)))
            prints.add(seed)
    prints = sorted(prints)
    groups = slow_components(prints)
    sizes = {6: 1, 7: 10**7, 9: 3 * 10**9}
    masks = simhash.grids(sizes[blocks])
    assert len(masks) == comb(blocks, 4)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "print long"), chunk=chunk, masks=masks)
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    mine = [roots.get(s, s) for (s,) in signed]
    assert len(set(zip(mine, groups))) == len(set(mine)) == len(set(groups))


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", None), (3, "One", "y"), (None, "one", "y"), (5, "one", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    found = {tuple(r) for r in simhash.near_duplicates(docs).select("doc_id", "component_id").collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (3, 3), (None, 3), (5, 3)}
    nothing = simhash.near_duplicates(docs.filter(F.lit(False)))
    assert nothing.count() == 0 and "component_id" in nothing.columns


def test_grids_stay_few():
    """A row per fingerprint and grid: their number must not follow the corpus."""
    assert [len(simhash.grids(10**k)) for k in (0, 6, 8, 9)] == [15, 15, 35, 70]
    assert len(simhash.grids(10**11)) <= 500


def test_one_of_each(spark):
    """The smallest id of a component stays; rows without an id stay; clashing names pass through."""
    rows = [(5, None, 1), (2, " \n", 2), (None, "a b", 3), (None, "a b", 4), (7, "A b", 5), (6, "a  B", 6), (6, "a b", 7), (8, "other", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, first int")
    kept = simhash.one_of_each(docs)
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 2, 6, 8] and kept.columns == docs.columns
    clashing = docs.withColumns({c: F.lit(None).cast("long") for c in ("_first", "print", "_Root", "a", "component_id")})
    assert sorted((r.doc_id or 0) for r in simhash.one_of_each(clashing).collect()) == [0, 0, 2, 6, 8]
    assert simhash.one_of_each(docs.filter(F.lit(False))).count() == 0


def test_components_of_a_hub(spark):
    """A hub, a chain, a loop and null ends; the lookups of a hub's edges are written, so its join can be split."""
    edges = [(0, i) for i in range(1, 300)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000), (None, 5), (7, None)]
    found = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 300)} | {i: 1000 for i in range(1001, 1061)}


def test_long_text():
    text = ("a b c d e f g " * 50_000).encode()
    assert simhash.fingerprint(text) == simhash.fingerprint(text[:-1])
