import random

import pytest

from pyspark.sql import functions as F

from shelfmark.operators import skew


SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_splits_hot_and_null_keys(spark, how):
    """A key of far more than sixteen tasks' worth of rows is split by its size, and every row is kept."""
    before = {name: spark.conf.get(name) for name in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 == 7, F.lit(None)).otherwise(F.concat(F.lit("k"), "id"))
        rows = spark.range(200_000).select("id", key.alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("text")).repartition(32)
        lookup = spark.createDataFrame([("hot", 1), ("k8", 2), ("unused", 3)], "key string, v int")
        joined = skew.join(rows, lookup, ["key"], how)
        joined = joined.groupBy("v").agg(F.count("*").alias("n"), F.count_distinct("text").alias("texts"))
        found = {r["v"]: (r["n"], r["texts"]) for r in joined.collect()}
        expected = {1: (140_000, 140_000), 2: (1, 1)} | ({None: (59_999, 59_999)} if how == "left" else {})
        assert found == expected
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan and "Broadcast" not in plan
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_top_k_and_distributed_rank_agree_with_sorting(spark):
    pick = random.Random(5)
    data = [("hot" if pick.random() < 0.6 else f"g{pick.randint(0, 5)}", pick.randint(0, 20), i) for i in range(600)]
    df = spark.createDataFrame(data, "g string, v int, id int")
    expected = {}
    for g in {d[0] for d in data}:
        for rank, row in enumerate(sorted((d for d in data if d[0] == g), key=lambda d: (-d[1], d[2])), start=1):
            expected[row[2]] = rank
    order = [F.desc("v"), F.col("id")]
    ranked = {r["id"]: r["rank"] for r in skew.distributed_rank(df, ["g"], order).collect()}
    assert ranked == expected
    top = {r["id"]: r["rank"] for r in skew.top_k(df, ["g"], order, 7, ["id"]).collect()}
    wide = skew.top_k(df.withColumn("k", F.lit(7)), ["g"], order, F.col("k"), ["id"], at_most=9)
    assert {r["id"]: r["rank"] for r in wide.collect()} == top
    assert top == {i: r for i, r in expected.items() if r <= 7}


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, None), ("b", 2, "z")], "k string, n int, v string")
    assert {tuple(r) for r in skew.first_per_key(df, ["k"], ["n"]).collect()} == {("a", 1, None), ("b", 2, "z")}


def test_top_k_limits_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("g", F.lit(1))
    plan = skew.top_k(df, ["g"], [F.col("id")], 5, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
