"""The stored search index: in step with the catalog, few segments, read by ranges, searched without taking texts apart."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from shelfmark import schemas as S
from shelfmark.operators import analysis, search, spelling
from shelfmark.plans import requests
from shelfmark.sources import events, segments, views
from shelfmark.streaming.apply import StreamApply

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def same(documents, index):
    """Entries and counts are those of the documents indexed anew."""
    fresh = segments.entries_of(documents)
    columns = ["field", "term", "id", "tf", "dl", "price", "sorts"]
    assert rows(index.alive(index.entries()).select(*columns)) == rows(fresh.select(*columns))
    assert rows(index.words()) == rows(spelling.vocabulary(documents))
    assert rows(index.terms()) == rows(analysis.term_stats(fresh))
    assert rows(index.fields()) == rows(analysis.field_stats(analysis.standard_fields(documents)))


def messages(spark):
    return events.encode(views.shared_name_changes(spark, SF)).withColumn("retry_count", F.lit(0)).select(*S.MESSAGE.names)


def part(feed, i, n):
    return feed.filter((F.col("seq_id") * n / 1000).cast("int") == i)


def test_stream_keeps_index_in_step(spark, tmp_path):
    """After every batch; a batch that fails before its commit leaves the former catalog and index, and is redone."""
    feed, n = messages(spark), 3
    for i in range(n):
        runner = StreamApply(spark, str(tmp_path), buckets=4, indexed=True)
        if i == 1:
            held = [rows(x) for x in (runner.searchable()[0], runner.searchable()[1].terms())]
            broken = StreamApply(spark, str(tmp_path))
            broken._commit = lambda *_: None
            broken.apply(part(feed, i, n), i)
            assert [rows(x) for x in (runner.searchable()[0], runner.searchable()[1].terms())] == held
        runner.apply(part(feed, i, n), i)
    runner.apply(part(feed, 0, n), 0)
    same(*runner.searchable())
    with pytest.raises(ValueError, match="without"):
        other = StreamApply(spark, str(tmp_path / "plain"), buckets=2)
        other.apply(part(feed, 0, n), 0)
        StreamApply(spark, str(tmp_path / "plain"), indexed=True)


def test_segments_are_merged(spark, tmp_path):
    """Sizes fall by a factor from segment to segment; what a later one names is gone from older ones."""
    index, catalog, most = segments.Segments(spark, str(tmp_path)), {}, 0
    batches = [(range(64), "alpha beta"), (range(3), "beta gamma"), (range(2, 5), "alpha"), (range(60, 66), None), (range(1), "gamma delta beta"), (range(30), "omega")]
    schema = "id string, name string, description string, price decimal(10,2)"
    for number, (ids, name) in enumerate(batches):
        before = [(i, *catalog.pop(i)) for i in map(str, ids) if i in catalog]
        now = [(str(i), name, f"rev {i % 3}", None) for i in ids] if name else []
        catalog |= {i: tuple(rest) for i, *rest in now}
        old = [s["number"] for s in index.live]
        index, replaced = index.add(number, spark.createDataFrame(now, schema), spark.createDataFrame(before, schema), len(now))
        sizes = [s["docs"] for s in index.live]
        assert all(a >= segments.FACTOR * b for a, b in zip(sizes, sizes[1:]))
        assert {f"version={n}" for n in old} - set(replaced) == {f"version={s['number']}" for s in index.live} - {f"version={number}"}
        most = max(most, len(index.live))
        if number in (2, 4, 5):
            same(spark.createDataFrame([(i, *rest) for i, rest in catalog.items()], schema), index)
    assert most == 3


def test_ranges_are_pruned(spark, monkeypatch):
    """With many documents terms lie in ranges; a search for one term reads one of them, by pruning at run time."""
    items = spark.range(3000).selectExpr("cast(id as string) id", "concat('word', id % 700) name", "'d' description", "cast(id as decimal(10,2)) price")
    plain = segments.build(items)
    monkeypatch.setattr(segments, "DOCUMENTS_PER_RANGE", 400)
    ranged = segments.build(items)
    assert len(ranged.bounds) >= 3 and not plain.bounds
    asked = search.settle(spark.createDataFrame([(1, "word123")], "spec_id int, term string"))
    found = ranged.matches(asked, ["tf"])
    assert rows(found) == rows(plain.matches(asked, ["tf"])) and found.count() > 3
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text
    assert ranged.entries().select("range").distinct().count() > 3


def test_searches_do_not_take_the_catalog_apart(spark, monkeypatch):
    """Given an index, no plan of a search tokenises more than the requests and the documents shown."""
    items = views.products(spark, SF)
    index = segments.build(items)
    plans, write = [], DataFrameWriter.parquet

    def watched(writer, *args, **kwargs):
        plans.append(writer._df._jdf.queryExecution().optimizedPlan().toString())
        return write(writer, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    run = search.Search(requests.searches(spark), items, index=index)
    results = [run.rows(), run.summary()]
    plans += [r._jdf.queryExecution().optimizedPlan().toString() for r in results]
    monkeypatch.undo()
    apart = [p for p in plans if "regexp_extract_all" in p and "p_name" in p]
    assert not apart
    assert results[0].count() > 100
