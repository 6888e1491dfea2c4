import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfmark import schemas as S
from shelfmark.operators import changes, uniqueness
from shelfmark.sources import events, versions, views
from shelfmark.streaming.apply import StreamApply, write_feed

SF = "/root/testdata/sf0.001"
COLUMNS = ["id", "name", "description", "price", "updatedAt", "priceChangedAt"]


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def part(feed, i, n):
    """The i-th of n consecutive stretches of the feed."""
    return feed.filter((F.col("seq_id") * n / 1000).cast("int") == i)


@pytest.mark.parametrize("batches", [1, 3])
def test_stream_equals_batch_fold(spark, tmp_path, batches):
    changed = views.shared_name_changes(spark, SF)
    feed = events.encode(changed).withColumn("retry_count", F.lit(0))
    runner = StreamApply(spark, str(tmp_path / "catalog"), buckets=4, files=2)
    for i in range(batches):
        write_feed(part(feed, i, batches).coalesce(1), str(tmp_path / "feed"))
        runner.run(str(tmp_path / "feed"), str(tmp_path / "progress"))
    expected = rows(uniqueness.fold_unique(changed))
    assert expected != rows(changes.fold(changed))
    assert rows(runner.catalog()) == expected
    replay = part(feed, 0, batches).select(*S.MESSAGE.names)
    runner.apply(replay, 0)
    assert rows(runner.catalog()) == expected


def test_interrupted_batch_is_redone(spark, tmp_path):
    feed = events.encode(views.changes(spark, SF)).withColumn("retry_count", F.lit(0)).select(*S.MESSAGE.names)
    runner = StreamApply(spark, str(tmp_path), buckets=4)
    runner.apply(part(feed, 0, 2), 0)
    broken = StreamApply(spark, str(tmp_path), buckets=4)
    broken._commit = lambda *_: None
    broken.apply(part(feed, 1, 2), 1)
    half = rows(changes.fold(views.changes(spark, SF).filter("seq_id < 500")))
    assert rows(runner.catalog()) == half
    runner.apply(part(feed, 1, 2), 1)
    assert rows(runner.catalog()) == rows(changes.fold(views.changes(spark, SF)))


def test_failures_are_retried_and_end_dead(spark, tmp_path):
    messages = views.messages(spark, SF).withColumn("retry_count", F.lit(0))
    runner = StreamApply(spark, str(tmp_path), buckets=4)
    for i in range(5):
        runner.apply(part(messages, i, 5), i)
    failed = events.decode(messages).filter("error is not null").count()
    queue = runner.queue()
    counts = {r["queue"]: r["count"] for r in queue.groupBy("queue").count().collect()}
    assert sum(counts.values()) == failed
    assert queue.filter(F.col("queue") == S.QUEUE_DEAD).filter("seq_id >= 400").isEmpty()
    assert queue.filter(F.col("queue") == S.QUEUE_RETRY).filter("seq_id < 200").isEmpty()


def test_keys_of_untouched_buckets_count(spark, tmp_path):
    feed = spark.createDataFrame([(f"2024-01-0{n + 1}", n, "CREATED", f"p{n}", "Same", "d") for n in range(6)], "t string, seq_id bigint, op string, id string, name string, description string")
    feed = events.encode(feed.withColumns({"seq_ts": F.col("t").cast("timestamp_ntz"), "price": F.lit(1)})).withColumn("retry_count", F.lit(0))
    runner = StreamApply(spark, str(tmp_path), buckets=64)
    for n in range(2):
        runner.apply(feed.filter(F.col("seq_id") % 2 == n), n)
    assert [r["id"] for r in runner.catalog().collect()] == ["p0"]


def test_dead_letters_survive_batches_without_a_time(spark, tmp_path):
    """Unreadable lines have no time, an empty batch has none either: nothing expires and every failure is kept."""
    broken = spark.createDataFrame([(None, i, None, "oops", 3) for i in range(2)], S.MESSAGE)
    timed = spark.createDataFrame([(dt.datetime(2024, 1, 1), 5, "CREATED", "{", 3)], S.MESSAGE)
    runner = StreamApply(spark, str(tmp_path), buckets=4)
    runner.apply(broken, 0)
    runner.apply(timed, 1)
    runner.apply(broken.withColumn("retry_count", F.lit(0)), 2)
    runner.apply(broken.limit(0), 3)
    found = {(r["seq_id"], r["queue"], r["dead_at"] and r["dead_at"].day) for r in runner.queue().collect()}
    assert found == {(i, S.QUEUE_DEAD, None) for i in range(2)} | {(5, S.QUEUE_DEAD, 1)} | {(i, S.QUEUE_RETRY, None) for i in range(2)}
    later = timed.withColumn("seq_ts", F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    runner.apply(later, 4)
    dead = runner.queue().filter(F.col("queue") == S.QUEUE_DEAD)
    assert sorted((r["seq_id"], r["dead_at"] and r["dead_at"].day or 0) for r in dead.collect()) == [(0, 0), (1, 0), (5, 15)]


def test_layout_is_kept(spark, tmp_path):
    feed = events.encode(views.changes(spark, SF)).withColumn("retry_count", F.lit(0)).select(*S.MESSAGE.names)
    StreamApply(spark, str(tmp_path), buckets=4).apply(part(feed, 0, 2), 0)
    with pytest.raises(ValueError):
        StreamApply(spark, str(tmp_path), buckets=64)
    runner = StreamApply(spark, str(tmp_path))
    runner.apply(part(feed, 1, 2), 1)
    assert runner.buckets == 4 and rows(runner.catalog()) == rows(changes.fold(views.changes(spark, SF)))


def test_work_of_a_batch_does_not_grow(spark, tmp_path, monkeypatch):
    """File-system calls and stored versions are the same after many batches; keys freed later are usable."""
    calls, location = [], versions.hadoop_path
    monkeypatch.setattr(versions, "hadoop_path", lambda *a: calls.append(a) or location(*a))
    runner, counts = StreamApply(spark, str(tmp_path), buckets=2), []
    for n in range(8):
        row = (dt.datetime(2024, 1, 1 + n), n, "CREATED" if n % 2 == 0 else "DELETED", '{"id":"p%d","name":"Same","description":"d"}' % (n // 2), 0)
        calls.clear()
        runner.apply(spark.createDataFrame([row], S.MESSAGE), n)
        counts.append(len(calls))
        assert runner.catalog().count() == (n % 2 == 0)
    assert counts[5] == counts[7] and counts[4] == counts[6]
    assert len(list((tmp_path / "catalog").iterdir())) <= 4 and len(list((tmp_path / "commits").glob("[0-9]*"))) == 2


def test_versions(spark, tmp_path):
    store = versions.CatalogVersions(spark, str(tmp_path / "catalog"))
    with pytest.raises(ValueError):
        store.read()
    assert store.write(spark.range(3)) == 1
    assert store.reindex(lambda df: df.withColumn("twice", F.col("id") * 2)) == 2
    assert store.read().columns == ["id", "twice"] and store.read(1).columns == ["id"]
    (tmp_path / "catalog" / "version=3").mkdir()
    assert store.current() == 2
    assert store.restore(1) == 4 and store.read().columns == ["id"]
    assert store.retire(keep=2) == [1] and store.versions() == [2, 4]
    with pytest.raises(ValueError):
        store.restore(1)
