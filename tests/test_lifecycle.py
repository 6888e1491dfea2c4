import datetime as dt
import io
from concurrent.futures import ThreadPoolExecutor
from threading import Barrier, Event

import pytest
from pyspark.sql import functions as F

from shelfmark import session
from shelfmark.operators import lifecycle
from shelfmark.sources import versions

DAY = dt.datetime(2024, 1, 1)


@pytest.fixture
def history(spark):
    rows = [
        (v, DAY + dt.timedelta(days=v), table, f"{table}{v}", "Hub 00ff3a", "d")
        for v in range(1, 11)
        for table in ("products", "labels", ".system")
    ]
    return spark.createDataFrame(rows, "version int, created_at timestamp_ntz, table_name string, id string, name string, description string")


def test_retention(history):
    assert {r["version"] for r in lifecycle.retain_versions(history).collect()} == set(range(4, 11))
    as_of = F.lit(DAY + dt.timedelta(days=10)).cast("timestamp_ntz")
    assert {r["version"] for r in lifecycle.retain_days(history, as_of).collect()} == set(range(3, 11))


def test_restore(history):
    assert {r["table_name"] for r in lifecycle.restore(history, 3).collect()} == {"products", "labels"}
    assert [r["id"] for r in lifecycle.restore(history, 3, "labels").collect()] == ["labels3"]
    with pytest.raises(ValueError):
        lifecycle.restore(history, 99)
    with pytest.raises(ValueError):
        lifecycle.restore(history, 3, "absent")


def test_reindex_and_snapshot(history):
    rebuilt = lifecycle.reindex(history, 10).collect()
    assert {(r["version"], r["nameSpellClean"]) for r in rebuilt} == {(11, "Hub")}
    taken = lifecycle.snapshot(history.select("id"), dt.datetime(2025, 11, 26, 22, 45, 4)).first()
    assert taken["version"] == "snapshot_2025-11-26_22-45-04" and taken["table_name"] == "products"


def test_refused_rename(monkeypatch):
    """A commit whose file the store does not accept is no commit."""

    class Store:
        def create(self, path, overwrite):
            return io.BytesIO()

        def rename(self, half, location):
            return False

    class Location(str):
        def suffix(self, end):
            return Location(self + end)

    monkeypatch.setattr(versions, "hadoop_path", lambda spark, path: (Location(path), Store()))
    with pytest.raises(OSError, match="commit.new"):
        versions.write_text(None, "folder/commit", "x")


def test_commit_file_is_written_once(spark, tmp_path):
    """Of two writers of a number the second fails, and what the first wrote stays."""
    versions.write_text(spark, f"{tmp_path}/commits/1", "first")
    with pytest.raises(OSError):
        versions.write_text(spark, f"{tmp_path}/commits/1", "second")
    assert versions.read_text(spark, f"{tmp_path}/commits/1") == "first"


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_commit_file_is_written_once_in_a_race(spark, tmp_path, prefix):
    """Of writers who start at once one gets the name, and nothing but its file is left."""
    start, names = Barrier(8), range(20)

    def attempts(writer):
        won = []
        for name in names:
            start.wait(60)
            try:
                versions.write_text(spark, f"{prefix}{tmp_path}/commits/{name}", f"writer {writer}")
                won.append(name)
            except OSError:
                pass
        return won

    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(attempts, range(8)))
    assert sorted(name for names in won for name in names) == list(names)
    for writer, name in ((w, n) for w, names in enumerate(won) for n in names):
        assert versions.read_text(spark, f"{prefix}{tmp_path}/commits/{name}") == f"writer {writer}"
    assert sorted(versions.children(spark, f"{tmp_path}/commits")) == sorted(map(str, names))


def test_one_of_two_writers_fails(spark, tmp_path):
    """Both begin from the same state: the second changes nothing, and its version goes."""
    first, second = (versions.CatalogVersions(spark, str(tmp_path)) for _ in range(2))
    first.write(spark.range(2))
    began = second.pointer()
    assert first.write(spark.range(3)) == 2
    with pytest.raises(versions.Conflict):
        second.write(spark.range(9), began=began)
    assert first.current() == second.current() == 2 and second.read().count() == 3 and first.versions() == [1, 2]
    assert second.write(spark.range(4)) == 4 and first.read().count() == 4


def test_writers_in_threads_take_numbers_of_their_own(spark, tmp_path):
    def attempt(n):
        store = versions.CatalogVersions(spark, str(tmp_path))
        try:
            return store.write(spark.range(n), began={"number": 0, "version": None, "changes": 0})
        except versions.Conflict:
            return None

    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(attempt, range(1, 5)))
    won = [n for n in numbers if n is not None]
    store = versions.CatalogVersions(spark, str(tmp_path))
    assert len(won) == 1 and store.versions() == won and store.current() == won[0]
    assert store.read().count() == numbers.index(won[0]) + 1


def test_reindex_during_a_feed_loses_nothing(spark, tmp_path):
    """Changes from before, from while the version is written, and from after its last look: each is folded in once."""
    store = versions.CatalogVersions(spark, str(tmp_path))
    store.write(spark.range(3))
    assert store.add_changes(spark.range(10, 12)) == 1
    looked = []

    def rebuild(documents):
        return documents.withColumn("twice", F.col("id") * 2)

    def replay(documents, changes):
        looked.append(sorted(r["id"] for r in changes.collect()))
        store.add_changes(spark.range(20 * len(looked), 20 * len(looked) + 1))
        return documents.unionByName(rebuild(changes))

    version = store.reindex(rebuild, replay)
    assert store.current() == version and looked == [[10, 11], [20]]
    assert {(r["id"], r["twice"]) for r in store.read().collect()} == {(n, 2 * n) for n in (0, 1, 2, 10, 11, 20)}
    assert [r["id"] for r in store.changes(store.pointer()["changes"]).collect()] == [40]
    store.reindex(lambda documents: documents, lambda documents, changes: documents.unionByName(rebuild(changes)))
    assert sorted(r["id"] for r in store.read().collect()) == [0, 1, 2, 10, 11, 20, 40]
    assert store.changes(store.pointer()["changes"]) is None
    assert store.retire(keep=1) == [1, version]


def test_scratch_of_two_threads(spark):
    """The end of one scope leaves the steps of another thread's scope alone."""
    open_, closed = Event(), Event()

    def long():
        with session.scratch(spark):
            step = session.settle(spark.range(5))
            open_.set()
            closed.wait(60)
            return step.count()

    def short():
        open_.wait(60)
        with session.scratch(spark):
            session.settle(spark.range(2))
        closed.set()

    with ThreadPoolExecutor(2) as pool:
        results = [pool.submit(long), pool.submit(short)]
        assert results[0].result() == 5 and results[1].result() is None
