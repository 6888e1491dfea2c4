"""Building blocks that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.session import settle

HOT_ROWS = 1_000_000


def join(rows: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join of `rows`, in which a key may be hot or null, with a lookup that has few rows per key.

    Left to Spark on purpose: it broadcasts a lookup of small measured size, and else splits partitions that turn out too
    large when they have been shuffled, into as many tasks as their size asks for, repeating only the lookup rows that meet them.
    That needs both sides to be plain shuffles, so aggregates on the join keys are written down before (`settle`).
    """
    return rows.join(lookup, [*on], how)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key as an aggregate, so rows combine before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*")


def top_k(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int | Column,
    salt_by: Sequence[str],
    rank: str = "rank",
    at_most: int | None = None,
) -> DataFrame:
    """The first k rows of each group with their rank; k is a number or a column constant in the group.

    Every shuffle partition gets a part of each group and keeps its own first k, so the final window sees at most that many
    times k rows of a group. Where k is a column, `at_most` may give its greatest value: up to 1000, tasks then cut
    their rows before the shuffle.
    """
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = at_most or (k if isinstance(k, int) else 2**31 - 1)
    local = Window.partitionBy(*group, "_salt").orderBy(*order)
    final = Window.partitionBy(*group).orderBy(*order)
    survivors = (
        df.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)))
        .withColumn("_local", F.row_number().over(local))
        .filter((F.col("_local") <= k) & (F.col("_local") <= limit))
        .drop("_local", "_salt")
    )
    return survivors.withColumn(rank, F.row_number().over(final)).filter(F.col(rank) <= k)


def distributed_rank(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], rank: str = "rank"
) -> DataFrame:
    """row_number over groups of any size without putting a group in one task.

    Rows are range-partitioned by (group, order), so a large group spans several partitions. Positions are
    written down, as range bounds may differ between runs; a count per (group, partition) then gives each
    partition its offset.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in group]
    placed = settle(
        df.repartitionByRange(parts, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_at", 33))
    spans = placed.groupBy(*group, "_part").agg(F.min("_at").alias("_from"), F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return (
        placed.join(offsets, [*group, "_part"])
        .withColumn(rank, F.col("_at") - F.col("_from") + F.col("_before") + 1)
        .drop("_at", "_part", "_from", "_before")
    )


def running(df: DataFrame, group: str, order: Column, columns: Sequence[str]) -> DataFrame:
    """Sums of columns up to and including each row of its group. A large group is cut by ranges of `order`, which is unique in it."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = settle(df.repartitionByRange(parts, F.col(group), order).withColumn("_part", F.spark_partition_id()))
    local = Window.partitionBy(group, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    within = placed.withColumns({c: F.sum(c).over(local) for c in columns})
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(group, "_part").agg(*[F.sum(c).alias(c) for c in columns])
    earlier = totals.select(group, "_part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in columns])
    joined = within.join(settle(earlier), [group, "_part"])
    return joined.withColumns({c: F.col(c) + F.col(f"_{c}") for c in columns}).select(*df.columns)


def hot_key_bounds(
    df: DataFrame, key: str, at: str, hot_rows: int | None = None, parts: int = 64
) -> DataFrame | None:
    """Split points of `at` for every key with more than `hot_rows` rows, or None if there is no such key.

    Only the most frequent keys are looked at, sixteen per shuffle partition; any other key has less than a
    sixteenth of an even partition's rows. That also bounds the result, which the driver turns into literal
    rows to make every use of it identical.
    """
    spark = df.sparkSession
    most = 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(key).count().filter((F.col("count") > (hot_rows or HOT_ROWS)) & F.col(key).isNotNull())
    hot = counts.orderBy(F.desc("count")).limit(most).select(key).collect()
    if not hot:
        return None
    keys = spark.createDataFrame(hot, df.select(key).schema)
    micros = F.col(at).cast("timestamp").cast("double")
    points = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    bounds = (
        df.join(F.broadcast(keys), key, "left_semi")
        .groupBy(key)
        .agg(F.percentile_approx(micros, points, F.lit(10_000)).alias("_bounds"))
    )
    return spark.createDataFrame(bounds.collect(), bounds.schema)


def chunk_of(df: DataFrame, key: str, at: str, bounds: DataFrame | None) -> DataFrame:
    """Add `hot`, and `chunk`: 0 for ordinary keys, the time slice for hot ones, in the order of `at`."""
    if bounds is None:
        return df.withColumns({"hot": F.lit(False), "chunk": F.lit(0)})
    micros = F.coalesce(F.col(at).cast("timestamp").cast("double"), F.lit(float("-inf")))
    slices = F.coalesce(F.size(F.filter("_bounds", lambda b: b < micros)), F.lit(0))
    return (
        df.join(F.broadcast(bounds), key, "left")
        .withColumns({"hot": F.col("_bounds").isNotNull(), "chunk": F.when(F.col("_bounds").isNotNull(), slices).otherwise(0)})
        .drop("_bounds")
    )
