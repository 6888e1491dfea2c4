"""Folding an ordered create/update/delete feed into a catalog.

Within one id an event's effect depends on the event just before it (is the product alive?) and on the last
applied price. Both are carried by windows over (id, chunk); chunks exist only for ids with very many events
and are stitched together by a window over one summary row per chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark import schemas as S
from shelfmark.operators import skew

SNAPSHOT = "SNAPSHOT"
REJECTED = "REJECTED"
_ORDER = ["seq_ts", "seq_id"]
_BEFORE = (Window.unboundedPreceding, -1)


def position() -> Column:
    """An event's place in the total order."""
    return F.struct(*_ORDER)


def forever() -> Column:
    """A place after every event."""
    return F.struct(
        F.expr("timestamp_ntz'9999-12-31 00:00:00'").alias("seq_ts"), F.lit(2**63 - 1).alias("seq_id")
    )


def timeline(
    changes: DataFrame, catalog: DataFrame | None, hot_rows: int | None
) -> tuple[DataFrame, bool]:
    """The feed with catalog rows as a first event of their id (op SNAPSHOT), and whether ids are chunked."""
    bounds = skew.hot_key_bounds(changes, "id", "seq_ts", hot_rows)
    feed = changes.select(
        *S.CHANGE.names, F.col("seq_ts").alias("updated_at"), F.col("seq_ts").alias("price_changed_at")
    )
    if catalog is not None:
        start = catalog.select(
            F.lit(None).cast("timestamp_ntz").alias("seq_ts"),
            F.lit(None).cast("bigint").alias("seq_id"),
            F.lit(SNAPSHOT).alias("op"),
            "id",
            "name",
            "description",
            F.col("price").cast(S.PRICE).alias("price"),
            F.col("updatedAt").alias("updated_at"),
            F.col("priceChangedAt").alias("price_changed_at"),
        )
        feed = feed.unionByName(start)
    return skew.chunk_of(feed, "id", "seq_ts", bounds), bounds is not None


def carry(feed: DataFrame, value: Column, name: str, chunked: bool, backwards: bool = False) -> DataFrame:
    """Add the last non-null `value` among earlier events of the same id (or the next one, going backwards)."""
    feed = feed.withColumn("_value", value)
    direction = F.desc if backwards else F.asc
    inside = Window.partitionBy("id", "chunk").orderBy(*[direction(c) for c in _ORDER]).rowsBetween(*_BEFORE)
    feed = feed.withColumn(name, F.last("_value", ignorenulls=True).over(inside))
    if chunked:
        edge = F.min_by if backwards else F.max_by
        place = F.when(F.col("_value").isNotNull(), position())
        tails = feed.filter("hot").groupBy("id", "chunk").agg(edge("_value", place).alias("_tail"))
        across = Window.partitionBy("id").orderBy(direction("chunk")).rowsBetween(*_BEFORE)
        carried = tails.withColumn("_carried", F.last("_tail", ignorenulls=True).over(across)).drop("_tail")
        feed = feed.join(carried, ["id", "chunk"], "left").withColumn(name, F.coalesce(name, "_carried")).drop("_carried")
    return feed.drop("_value")


def annotate(
    changes: DataFrame,
    catalog: DataFrame | None = None,
    hot_rows: int | None = None,
    rejected: DataFrame | None = None,
) -> DataFrame:
    """Add outcome, applied and marks_price to every event, given the catalog before the feed.

    `rejected` holds the seq_id of CREATED events that lose to another product's key (see uniqueness.py).
    `updated_at` and `price_changed_at` hold the times the event would set.
    """
    if rejected is not None:
        lost = rejected.select("seq_id", F.lit(REJECTED).alias("_lost")).distinct()
        changes = changes.join(lost, "seq_id", "left").withColumn("op", F.coalesce("_lost", "op")).drop("_lost")
    feed, chunked = timeline(changes, catalog, hot_rows)
    op = F.col("op")
    feed = carry(feed, F.when(op != REJECTED, op), "prev_op", chunked)
    alive = F.coalesce(F.col("prev_op") != S.DELETED, F.lit(False))
    outcome = (
        F.when(op == SNAPSHOT, SNAPSHOT)
        .when(op.isin(S.CREATED, REJECTED) & alive, "ignored_id")
        .when(op == REJECTED, "ignored_key")
        .when(op == S.CREATED, "created")
        .when((op == S.UPDATED) & alive, "updated")
        .when(op == S.UPDATED, "created_from_update")
        .when(alive, "deleted")
        .otherwise("ignored_missing")
    )
    feed = feed.withColumn("outcome", outcome).withColumn(
        "applied", F.col("outcome").isin(SNAPSHOT, "created", "updated", "created_from_update")
    )

    state = F.when(
        F.col("applied") | (op == S.DELETED),
        F.struct((op == S.DELETED).alias("gone"), F.col("price").alias("price")),
    )
    feed = carry(feed, state, "prev", chunked)
    first = F.col("prev").isNull() | F.col("prev.gone")
    price, before = F.col("price"), F.col("prev.price")
    changed = first | before.isNull() | F.coalesce(price != before, F.lit(False))
    return feed.withColumn("marks_price", F.col("applied") & changed).drop("prev")


def outcomes(annotated: DataFrame) -> DataFrame:
    """(seq_id, id, op, outcome) per event."""
    op = F.when(F.col("op") == REJECTED, S.CREATED).otherwise(F.col("op"))
    return annotated.filter(F.col("op") != SNAPSHOT).select("seq_id", "id", op.alias("op"), "outcome")


def catalog_of(annotated: DataFrame) -> DataFrame:
    """The catalog after the feed: id, name, description, price, updatedAt, priceChangedAt."""
    last = F.struct("name", "description", "price", "updated_at")
    return (
        annotated.groupBy("id")
        .agg(
            F.max_by("op", F.when(F.col("op") != REJECTED, position())).alias("_op"),
            F.max_by(last, F.when(F.col("applied"), position())).alias("_doc"),
            F.max_by("price_changed_at", F.when(F.col("marks_price"), position())).alias("priceChangedAt"),
        )
        .filter(F.col("_op") != S.DELETED)
        .select(
            "id",
            "_doc.name",
            "_doc.description",
            "_doc.price",
            F.col("_doc.updated_at").alias("updatedAt"),
            "priceChangedAt",
        )
    )


def fold(
    changes: DataFrame,
    catalog: DataFrame | None = None,
    hot_rows: int | None = None,
    rejected: DataFrame | None = None,
) -> DataFrame:
    """The catalog after applying an ordered mixed feed to an optional catalog."""
    return catalog_of(annotate(changes, catalog, hot_rows, rejected))


def apply_updated(updates: DataFrame, catalog: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Overwrite found products, insert missing ones; no uniqueness check."""
    return fold(updates.filter(F.col("op") == S.UPDATED), catalog, hot_rows)


def apply_deleted(deletes: DataFrame, catalog: DataFrame) -> DataFrame:
    """Remove products by id; unknown ids are ignored."""
    gone = deletes.filter(F.col("op") == S.DELETED).select("id").distinct()
    return catalog.join(gone, "id", "left_anti")


def versioned_update(updates: DataFrame) -> DataFrame:
    """Add `won`: the first update per (id, expected_version). The others lost the race and go to retry."""
    winners = (
        updates.groupBy("id", "expected_version")
        .agg(F.min(F.struct(*_ORDER)).alias("_first"))
        .select(F.col("_first.seq_id").alias("seq_id"), F.lit(True).alias("won"))
    )
    return updates.join(winners, "seq_id", "left").withColumn("won", F.coalesce("won", F.lit(False)))
