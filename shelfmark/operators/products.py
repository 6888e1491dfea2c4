"""Product rows: lookup, seeding, search columns and uniqueness rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import schemas as S
from shelfmark.functions import text as tx
from shelfmark.operators import skew
from shelfmark.session import settle
from shelfmark.sources.events import encode


def search_columns(products: DataFrame) -> DataFrame:
    """Add the derived columns of the search document."""
    name, description = F.col("name"), F.col("description")
    return products.withColumns(
        {
            "nameSpell": name,
            "nameSpellClean": tx.clean_name(name),
            "uniqueKey": tx.unique_key(name, description),
            "normalizedKey": tx.normalized_key(name, description),
        }
    )


def documents(products: DataFrame, at: Column) -> DataFrame:
    """Product rows as new search documents, stamped with one time."""
    return search_columns(products).withColumns({"updatedAt": at, "priceChangedAt": at})


def price_filter(df: DataFrame, low: float | None, high: float | None, column: str = "price") -> DataFrame:
    """Rows with low <= price <= high; a missing bound does not restrict."""
    if low is not None:
        df = df.filter(F.col(column) >= low)
    if high is not None:
        df = df.filter(F.col(column) <= high)
    return df


def lookup(requests: DataFrame, products: DataFrame) -> DataFrame:
    """Products by id for a table of (request_id, id), with a found flag."""
    known = products.withColumn("found", F.lit(True))
    found = skew.join(requests, known, ["id"], "left")
    return found.withColumn("found", F.coalesce("found", F.lit(False)))


def seed_if_empty(seed: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Products to insert, their CREATED events, and rejected seed rows; nothing is inserted when the target has rows.

    Ids are a digest of name and description, so a second run yields the same rows. The table is unique on that pair: the
    first row of it, by `position`, is inserted and the others are rejected with its id as `holder`.
    """
    wanted = seed if target.isEmpty() else seed.limit(0)
    pair = ["name", "description"]
    keyed = wanted.withColumn("id", F.sha2(F.to_json(F.array(*pair)), 256))
    first = skew.first_per_key(keyed, ["id"], ["position"])
    held = first.select("id", F.col("position").alias("_first"))
    rejected = skew.join(keyed, settle(held), ["id"]).filter(F.col("position") != F.col("_first"))
    inserted = first.select("id", *pair, "price", "position")
    created = inserted.select(
        F.lit(None).cast("timestamp_ntz").alias("seq_ts"),
        F.lit(None).cast("bigint").alias("seq_id"),
        F.lit(S.CREATED).alias("op"),
        *S.PRODUCT.names,
    )
    return (
        inserted.drop("position"),
        encode(created).drop("seq_ts", "seq_id"),
        rejected.select("position", *pair, "price", F.col("id").alias("holder")),
    )


def duplicate_creates(batch: DataFrame, existing: DataFrame) -> DataFrame:
    """Add `holder`: null if the row may be inserted, else the id that already has this exact pair.

    `batch` has seq_id, id, name, description; a pair in the existing table wins over any in the batch.
    """
    pair = ["name", "description"]
    held = existing.groupBy(*pair).agg(F.min("id").alias("_existing"))
    first = skew.first_per_key(batch.select(*pair, "seq_id", "id"), pair, ["seq_id"])
    owners = (
        first.join(held, pair, "left")
        .withColumn("holder", F.coalesce("_existing", "id"))
        .select(*pair, "holder", F.when(F.col("_existing").isNull(), F.col("seq_id")).alias("_first"))
    )
    marked = skew.join(batch, owners, pair)
    is_first = F.coalesce(F.col("_first") == F.col("seq_id"), F.lit(False))
    return marked.withColumn("holder", F.when(~is_first, F.col("holder"))).drop("_first")


def duplicate_updates(updates: DataFrame, products: DataFrame) -> DataFrame:
    """Add `found` and `duplicate`: the new pair belongs to another id. An unchanged pair is not checked."""
    pair = ["name", "description"]
    owners = products.groupBy(*pair).agg(F.min("id").alias("_low"), F.max("id").alias("_high"))
    current = products.select("id", F.col("name").alias("_name"), F.col("description").alias("_description"))
    with_current = skew.join(updates, current.withColumn("found", F.lit(True)), ["id"], "left")
    judged = skew.join(with_current, owners, pair, "left")
    changed = ~(F.col("name").eqNullSafe(F.col("_name")) & F.col("description").eqNullSafe(F.col("_description")))
    other = (F.col("_low") != F.col("id")) | (F.col("_high") != F.col("id"))
    return judged.withColumns(
        {
            "found": F.coalesce("found", F.lit(False)),
            "duplicate": F.coalesce(F.col("found") & changed & other, F.lit(False)),
        }
    ).drop("_low", "_high", "_name", "_description")


def dedupe_by_id(batch: DataFrame, existing: DataFrame, order: list[str]) -> DataFrame:
    """The first row of each id that the catalog does not have."""
    return skew.first_per_key(batch, ["id"], order).join(existing.select("id"), "id", "left_anti")


def dedupe_by_key(batch: DataFrame, existing: DataFrame, order: list[str]) -> DataFrame:
    """The first row of each normalised key that the catalog does not have; needs column normalizedKey."""
    first = skew.first_per_key(batch, ["normalizedKey"], order)
    return first.join(existing.select("normalizedKey").distinct(), "normalizedKey", "left_anti")


def distinct_names(ranked: DataFrame, group: str, limit: int = 10) -> DataFrame:
    """From the first `limit` ranks of each group: distinct non-null names in rank order."""
    best = (
        ranked.filter((F.col("rank") <= limit) & F.col("name").isNotNull())
        .groupBy(group, "name")
        .agg(F.min("rank").alias("_best"))
    )
    return skew.top_k(best, [group], [F.col("_best")], limit, ["name"], rank="position").drop("_best")
