"""Nodes of the trie against plain nested dictionaries."""

import hashlib
import random
import zlib

import duckdb
import pytest

from shelfmark.llm import prefix_trie
from shelfmark.llm.queries import QUERIES


def slow_turns(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs.setdefault(c, []).append(((turn is not None, turn or 0), digest, (role, text)))
    return {c: [t for *_, t in sorted(turns)] for c, turns in convs.items()}


def slow_rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - abs(c) % 5 * (1 if c > 0 else -1), [])[:h] + turns[h:]
    return out


def slow_trie(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for key in members:
        if key:
            children.setdefault(key[:-1], []).append(key)
    rows, leaves, saved = [], {}, {}
    for key in sorted(members, key=len, reverse=True):
        mine = members[key]
        below = children.get(key, [])
        leaves[key] = sum(leaves[k] for k in below) or 1
        saved[key] = sum(saved[k] for k in below) + (len(mine) - 1) * (len(key[-1][1].encode()) if key else 0)
        ends = ",".join(map(str, sorted(c for c in mine if len(convs[c]) == len(key))))
        parent = min(members[key[:-1]]) if key else None
        rows.append((min(mine), len(key), parent, len(mine), len(below), leaves[key], saved[key], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query(spark, sf):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '/root/testdata/{sf}/conversations.parquet'").fetchall()
    assert got(QUERIES["op13_prefix_trie"](spark, f"/root/testdata/{sf}")) == slow_trie(slow_rebuilt(slow_turns(rows)))


SCHEMA = "conv_id long, turn int, role string, text string, conv string, depth int, `a.b` int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 3, None) for r in rows], SCHEMA)


def test_branches_at_every_depth(spark):
    """Copies, prefixes of each other, long shared beginnings, nested chains, and a conversation with most of the turns."""
    r = random.Random(4)
    trunk = [(r.choice(["user", "assistant", None]), f"é{n} " * r.randrange(3)) for n in range(40)]
    rows = []
    for c in range(60):
        n = r.choice([1, 3, 4, 5, 8, 12, 39, 40]) if c % 3 else 12
        turns = trunk[:n] + [("user", r.choice("ab")) for _ in range(r.randrange(6) if c % 3 else 0)]
        rows += [(c * 7 - 40, t, *said) for t, said in enumerate(turns)]
    rows += [(1000 + c, t, "user", "deep" if t < c else "end") for c in range(9) for t in range(c + 1)]
    rows += [(2000, t, "user", str(t % 3)) for t in range(3000)]
    convs = slow_turns(rows)
    assert got(prefix_trie.prefix_trie(frame(spark, rows))) == slow_trie(convs)
    assert got(prefix_trie.report(frame(spark, rows))) == slow_trie(slow_rebuilt(convs))


def test_odd_rows(spark):
    """Null ids, turns, roles and texts, repeated rows, equal turn numbers, negative ids, roles that run into texts."""
    rows = [
        (None, 1, "user", "lost"), (5, None, "user", "first"), (5, 0, None, None), (5, 0, "", ""), (5, 0, "b", "x"), (5, 0, "a", "y"), (6, 1, "user", "a"), (6, 1, "user", "a"),
        (7, -3, "us", "era"), (8, -3, "user", "a"), (9, 2, "1:x", "y"), (10, 2, "1", ":xy"), (-3, 0, "q", "q"), (-5, 0, "q", "q"), (-5, 1, "q", "z" * 100_000),
    ]
    convs = slow_turns(rows)
    assert got(prefix_trie.prefix_trie(frame(spark, rows))) == slow_trie(convs)
    assert got(prefix_trie.report(frame(spark, rows))) == slow_trie(slow_rebuilt(convs))


def test_turnless_and_empty(spark):
    """Rebuilt conversations without turns are members of the root; an empty table has no nodes."""
    turnless = [c for c in range(1, 60) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1]
    rows = [(c, 0, "user", "hi") for c in turnless]
    assert got(prefix_trie.report(frame(spark, rows))) == slow_trie(slow_rebuilt(slow_turns(rows)))
    assert got(prefix_trie.report(frame(spark, rows)))[0][:5] == (min(turnless), 0, None, len(turnless), 0)
    assert got(prefix_trie.report(frame(spark, []))) == []


def test_many_ends_in_pieces(spark, monkeypatch):
    """A node's ids are joined in pieces and hashed in order."""
    monkeypatch.setattr(prefix_trie, "PIECE", 50)
    rows = [(c, 0, "system", "same") for c in range(-700, 700)]
    assert got(prefix_trie.prefix_trie(frame(spark, rows))) == slow_trie(slow_turns(rows))
