import datetime as dt
import random
from decimal import Decimal

import pytest

from shelfmark import schemas as S
from shelfmark.operators import changes, uniqueness

START = dt.datetime(2024, 1, 1)


def event(n, op, id_, price, name="n", description="d"):
    cost = None if op == "DELETED" or price is None else Decimal(price).quantize(Decimal("0.01"))
    return (START + dt.timedelta(seconds=n), n, op, id_, name, description, cost)


def one_by_one(feed, catalog=(), unique=False):
    """The handlers applied to one event at a time."""
    docs, outcomes = {row[0]: list(row) for row in catalog}, {}
    for ts, seq, op, id_, name, description, price in sorted(feed, key=lambda e: (e[0], e[1])):
        held = docs.get(id_)
        if op == "CREATED":
            taken = unique and (name, description) in {(d[1], d[2]) for d in docs.values()}
            outcomes[seq] = "ignored_id" if held else "ignored_key" if taken else "created"
            if outcomes[seq] == "created":
                docs[id_] = [id_, name, description, price, ts, ts]
        elif op == "UPDATED":
            outcomes[seq] = "updated" if held else "created_from_update"
            if not held:
                docs[id_] = [id_, name, description, price, ts, ts]
            else:
                moved = held[3] is None or (price is not None and price != held[3])
                docs[id_] = [id_, name, description, price, ts, ts if moved else held[5]]
        else:
            outcomes[seq] = "deleted" if held else "ignored_missing"
            docs.pop(id_, None)
    return {k: tuple(v) for k, v in docs.items()}, outcomes


def rows(df):
    columns = ["id", "name", "description", "price", "updatedAt", "priceChangedAt"]
    return {r["id"]: tuple(r[c] for c in columns) for r in df.collect()}


CASES = {
    "cc": ["CREATED 1", "CREATED 2"],
    "cu same price": ["CREATED 1", "UPDATED 1"],
    "cu new price": ["CREATED 1", "UPDATED 2"],
    "u": ["UPDATED 1"],
    "cd": ["CREATED 1", "DELETED 0"],
    "cdu": ["CREATED 1", "DELETED 0", "UPDATED 1"],
    "d": ["DELETED 0"],
    "dc": ["DELETED 0", "CREATED 1"],
    "udcu": ["UPDATED 1", "DELETED 0", "CREATED 1", "UPDATED 1"],
    "ignored price": ["CREATED 1", "CREATED 2", "UPDATED 1"],
}


def test_documented_cases(spark):
    feed, n = [], 0
    for id_, steps in CASES.items():
        for step in steps:
            op, price = step.split()
            feed.append(event(n, op, id_, price, f"name {n}"))
            n += 1
    docs, outcomes = one_by_one(feed)
    annotated = changes.annotate(spark.createDataFrame(feed, S.CHANGE))
    assert rows(changes.catalog_of(annotated)) == docs
    assert {r["seq_id"]: r["outcome"] for r in changes.outcomes(annotated).collect()} == outcomes


@pytest.mark.parametrize("hot_rows", [None, 25])
def test_fold_equals_one_by_one(spark, hot_rows):
    pick = random.Random(7)
    ids = [f"p{i}" for i in range(30)]
    feed = [
        event(
            n,
            pick.choice(["CREATED", "UPDATED", "UPDATED", "DELETED"]),
            "hot" if pick.random() < 0.4 else pick.choice(ids),
            pick.choice([None, 1, 2, 2]),
            f"name {n}",
        )
        for n in range(900)
    ]
    old = START - dt.timedelta(days=1)
    catalog = [(f"p{i}", "old", "old", Decimal("2.00"), old, old) for i in range(0, 40, 2)]
    schema = "id string, name string, description string, price decimal(10,2), updatedAt timestamp_ntz, priceChangedAt timestamp_ntz"
    annotated = changes.annotate(
        spark.createDataFrame(feed, S.CHANGE), spark.createDataFrame(catalog, schema), hot_rows
    )
    docs, outcomes = one_by_one(feed, catalog)
    assert rows(changes.catalog_of(annotated)) == docs
    assert {r["seq_id"]: r["outcome"] for r in changes.outcomes(annotated).collect()} == outcomes
    if hot_rows:
        assert annotated.select("chunk").distinct().count() > 1


@pytest.mark.parametrize("seed, hot_rows, names", [(1, None, 12), (2, 30, 6), (3, 20, 40)])
def test_unique_fold_equals_one_by_one(spark, seed, hot_rows, names):
    pick = random.Random(seed)
    feed = []
    for n in range(500):
        op = pick.choice(["CREATED", "CREATED", "UPDATED", "DELETED", "DELETED"])
        id_ = "hot" if pick.random() < 0.2 else f"p{pick.randint(0, 25)}"
        name = "hot name" if pick.random() < 0.3 else f"name {pick.randint(0, names)}"
        feed.append(event(n, op, id_, pick.choice([1, 2]), name))
    old = START - dt.timedelta(days=1)
    catalog = [(f"p{i}", f"name {i}", "d", Decimal("2.00"), old, old) for i in range(0, 40, 3)]
    schema = "id string, name string, description string, price decimal(10,2), updatedAt timestamp_ntz, priceChangedAt timestamp_ntz"
    annotated = uniqueness.annotate_unique(
        spark.createDataFrame(feed, S.CHANGE), spark.createDataFrame(catalog, schema), hot_rows
    )
    docs, outcomes = one_by_one(feed, catalog, unique=True)
    assert {r["seq_id"]: r["outcome"] for r in changes.outcomes(annotated).collect()} == outcomes
    assert rows(changes.catalog_of(annotated)) == docs


def test_long_chains_take_few_rounds(spark, monkeypatch):
    """A thousand events of which each waits for the one before, and chains that branch."""
    feed = [event(0, "CREATED", "p0", 1, "name 0")]
    for link in range(500):
        feed.append(event(2 * link + 1, "CREATED", f"p{link + 1}", 1, f"name {link}"))
        feed.append(event(2 * link + 2, "CREATED", f"p{link + 1}", 1, f"name {link + 1}"))
    pick = random.Random(8)
    feed += [event(n, "CREATED", f"q{pick.randint(0, 30)}", 1, f"other {pick.randint(0, 25)}") for n in range(2000, 2300)]
    settled, settle = [], uniqueness.settle
    monkeypatch.setattr(uniqueness, "settle", lambda df: settled.append(df.columns) or settle(df))
    annotated = uniqueness.annotate_unique(spark.createDataFrame(feed, S.CHANGE))
    docs, outcomes = one_by_one(feed, unique=True)
    assert {r["seq_id"]: r["outcome"] for r in changes.outcomes(annotated).collect()} == outcomes
    assert rows(changes.catalog_of(annotated)) == docs and len(settled) < 20
    monkeypatch.setattr(uniqueness, "ROUNDS", 0)
    again = changes.outcomes(uniqueness.annotate_unique(spark.createDataFrame(feed[900:], S.CHANGE))).collect()
    assert {r["seq_id"]: r["outcome"] for r in again} == one_by_one(feed[900:], unique=True)[1]


def _chains(links, seed):
    """Chains of events that wait for each other, branches, holders with ends, and ids and names that are used again."""
    pick = random.Random(seed)
    feed = [event(0, "CREATED", "p0", 1, "name 0")]
    for link in range(links):
        feed.append(event(3 * link + 1, "CREATED", f"p{link + 1}", 1, f"name {link}"))
        feed.append(event(3 * link + 2, "CREATED", f"p{link + 1}", 1, f"name {link + 1}"))
        if pick.random() < 0.5:
            op, near = pick.choice(["CREATED", "UPDATED", "DELETED"]), pick.randint(max(0, link - 40), link)
            feed.append(event(3 * link + 3, op, f"p{near}", 1, f"name {pick.randint(max(0, link - 40), link)}"))
    return feed


@pytest.mark.parametrize("rounds, size, seed", [(0, 1, 11), (0, 7, 12), (2, 30, 13), (6, 1000, 14)])
def test_chains_in_slices_equal_one_by_one(spark, monkeypatch, rounds, size, seed):
    """A group is decided slice by slice, of any size, also one event at a time."""
    monkeypatch.setattr(uniqueness, "ROUNDS", rounds)
    monkeypatch.setattr(uniqueness, "SLICE", size)
    feed = _chains(3 if size == 1 else 12 if size == 7 else 60, seed)
    annotated = uniqueness.annotate_unique(spark.createDataFrame(feed, S.CHANGE))
    docs, outcomes = one_by_one(feed, unique=True)
    assert {r["seq_id"]: r["outcome"] for r in changes.outcomes(annotated).collect()} == outcomes
    assert rows(changes.catalog_of(annotated)) == docs


def test_no_task_holds_more_than_a_slice(spark, monkeypatch):
    """Of a group of 6000 events no pass hands more than a slice to a task, and times survive as exact numbers."""
    seen, slices = [], uniqueness._slices
    monkeypatch.setattr(uniqueness, "SLICE", 1000)
    monkeypatch.setattr(uniqueness, "_slices", lambda events: seen.append(slices(events)) or seen[-1])
    feed = _chains(3000, 15)
    annotated = uniqueness.annotate_unique(spark.createDataFrame(feed, S.CHANGE))
    assert {r["seq_id"]: r["outcome"] for r in changes.outcomes(annotated).collect()} == one_by_one(feed, unique=True)[1]
    sizes = [r["count"] for r in seen[0].groupBy("root", "slice").count().collect()]
    assert max(sizes) == 1000 and len(sizes) > 3


@pytest.mark.parametrize("seed", [4, 5])
def test_creates_alone_equal_one_by_one(spark, seed):
    pick = random.Random(seed)
    feed = [event(n, "CREATED", f"p{pick.randint(0, 40)}", 1, pick.choice(["hot", f"n{pick.randint(0, 40)}"])) for n in range(150)]
    schema = "id string, name string, description string, price decimal(10,2), updatedAt timestamp_ntz, priceChangedAt timestamp_ntz"
    catalog = [("p1", "n1", "d", None, START, START), ("p99", "n2", "d", None, START, START)]
    done = uniqueness.apply_created(spark.createDataFrame(feed, S.CHANGE), spark.createDataFrame(catalog, schema))
    assert {r["seq_id"]: r["outcome"] for r in done.collect()} == one_by_one(feed, catalog, unique=True)[1]


def test_updated_and_deleted_alone(spark):
    old = START - dt.timedelta(days=1)
    schema = "id string, name string, description string, price decimal(10,2), updatedAt timestamp_ntz, priceChangedAt timestamp_ntz"
    catalog = spark.createDataFrame([("a", "x", "y", Decimal("1.00"), old, old), ("b", "x", "y", Decimal("1.00"), old, old)], schema)
    feed = spark.createDataFrame([event(1, "UPDATED", "a", 1), event(2, "UPDATED", "c", 3), event(3, "DELETED", "b", 0)], S.CHANGE)
    updated = rows(changes.apply_updated(feed, catalog))
    assert updated["a"][4] == START + dt.timedelta(seconds=1) and updated["a"][5] == old
    assert set(updated) == {"a", "b", "c"}
    assert {r["id"] for r in changes.apply_deleted(feed, catalog).collect()} == {"a"}


def test_versioned_update_has_one_winner(spark):
    rows_ = [(START, 1, "a", 1), (START, 2, "a", 1), (START, 3, "a", 2), (START, 4, "b", 1)]
    judged = changes.versioned_update(spark.createDataFrame(rows_, "seq_ts timestamp_ntz, seq_id int, id string, expected_version int"))
    assert {r["seq_id"]: r["won"] for r in judged.collect()} == {1: True, 2: False, 3: True, 4: True}
