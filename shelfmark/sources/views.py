"""Adapters from the test tables to the product, change-feed and message schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import schemas as S
from shelfmark.sources.events import encode


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_scan(df: DataFrame) -> DataFrame:
    """Redistribute a scan with fewer splits than twice the cores, so text work uses all of them.

    A large table has many more splits and is left as it is: its rows are not moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * 2) if df.rdd.getNumPartitions() < cores * 2 else df


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, text) of the documents."""
    text = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    return spread_scan(text)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("name"),
        F.concat_ws(" ", "p_brand", "p_type").alias("description"),
        F.col("p_retailprice").cast(S.PRICE).alias("price"),
    )


def product_changes(spark: SparkSession, sf_dir: str, op: str = S.CREATED) -> DataFrame:
    """The products as events in key order, one per second, after the change feed."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.expr("timestamp_ntz'2024-02-01 00:00:00' + make_dt_interval(0, 0, 0, p_partkey)").alias("seq_ts"),
        F.col("p_partkey").alias("seq_id"),
        F.lit(op).alias("op"),
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("name"),
        F.concat_ws(" ", "p_brand", "p_type").alias("description"),
        F.col("p_retailprice").cast(S.PRICE).alias("price"),
    )


def _k(props) -> F.Column:
    return F.get_json_object(props, "$.k").cast("int")


def _op() -> F.Column:
    kind = F.col("event_type")
    return F.when(kind == "signup", S.CREATED).when(kind == "error", S.DELETED).otherwise(S.UPDATED)


def changes(spark: SparkSession, sf_dir: str, keep: Sequence[str] = ()) -> DataFrame:
    """The change feed, and columns of the events to keep."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("seq_ts"),
        F.col("event_id").alias("seq_id"),
        _op().alias("op"),
        F.col("user_id").cast("string").alias("id"),
        F.concat(F.lit("product "), F.col("user_id")).alias("name"),
        F.concat(F.lit("rev "), _k("props")).alias("description"),
        F.when(_op() != S.DELETED, F.col("value")).cast(S.PRICE).alias("price"),
        *keep,
    )


def shared_name_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed with a name and description shared by many products."""
    name = F.concat(F.lit("Product "), F.right(F.col("id"), F.lit(1)))
    return changes(spark, sf_dir).withColumns({"name": name, "description": F.lit("rev")})


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product requests, some of them invalid: (row_id, name, description, price)."""
    kind, k, value = F.col("event_type"), _k("props"), F.col("value").cast("decimal(14,4)")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"),
        F.when(kind == "error", F.lit(" \t "))
        .when(kind == "purchase", F.repeat(F.lit("abc"), k))
        .otherwise(F.concat(F.lit("product "), F.col("user_id")))
        .alias("name"),
        F.when((kind == "click") & (k < 30), F.lit(None)).otherwise(F.concat(F.lit("rev "), k)).alias("description"),
        F.when(kind == "signup", value * 1000000)
        .when(k == 0, F.lit(None))
        .otherwise(value - 50)
        .cast("decimal(14,4)")
        .alias("price"),
    )


def update_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renames (to another product's text), description edits and price-only edits of products."""
    events = table(spark, sf_dir, "events").filter(F.col("event_type") != "signup")
    items = products(spark, sf_dir)
    current = items.select("id", F.col("name").alias("c_name"), F.col("description").alias("c_description"))
    other = items.select(
        F.col("id").alias("other_id"), F.col("name").alias("o_name"), F.col("description").alias("o_description")
    )
    kind = F.col("event_type")
    return (
        events.select(
            F.col("event_id").alias("seq_id"),
            F.col("user_id").cast("string").alias("id"),
            _k("props").cast("string").alias("other_id"),
            "event_type",
            F.col("value").cast(S.PRICE).alias("price"),
        )
        .join(current, "id")
        .join(other, "other_id")
        .select(
            "seq_id",
            "id",
            F.when(kind == "purchase", F.col("o_name")).otherwise(F.col("c_name")).alias("name"),
            F.when(kind == "purchase", F.col("o_description"))
            .when(kind == "click", F.concat("c_description", F.lit(" rev "), "other_id"))
            .otherwise(F.col("c_description"))
            .alias("description"),
            "price",
        )
    )


def lookup_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(request_id, id): order keys used as product ids, so some are found and some are not."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("request_id"),
        F.col("l_orderkey").cast("string").alias("id"),
    )


def versioned_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates that carry the version they read: (seq_ts, seq_id, id, expected_version, retry_count)."""
    return (
        table(spark, sf_dir, "events")
        .filter(_op() == S.UPDATED)
        .select(
            F.col("ts").alias("seq_ts"),
            F.col("event_id").alias("seq_id"),
            F.col("user_id").cast("string").alias("id"),
            _k("props").alias("expected_version"),
            F.pmod(_k("props"), F.lit(5)).cast("int").alias("retry_count"),
        )
    )


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages, and k of their event."""
    feed = encode(changes(spark, sf_dir, ["event_type", "props"]), ["event_type", "props"])
    kind, k, body = F.col("event_type"), _k("props"), F.col("payload")
    cut = body.substr(F.lit(1), F.length(body) - 1)
    return feed.select(
        "seq_ts",
        "seq_id",
        "op",
        F.when(kind == "click", F.col("props"))
        .when((kind == "purchase") & (k < 50), cut)
        .when((kind == "error") & (k < 20), F.concat(cut, F.lit(',"price":1}')))
        .when((kind == "signup") & (k < 10), F.lit('{"id":null,"name":"x"}'))
        .when((kind == "signup") & (k < 15), F.lit('{"id":"1","name":{"text":"x"},"price":2}'))
        .when((kind == "signup") & (k < 20), F.lit('{"id":"1","name":"x","description":["y"]}'))
        .when((kind == "signup") & (k < 25), F.concat(cut, F.lit(',"updatedAt":"garbage"}')))
        .when((kind == "signup") & (k < 30), F.concat(cut, F.lit(',"priceChangedAt":"2024-01-05T06:07:08Z"}')))
        .when((kind == "signup") & (k < 35), F.lit('{"id":7,"name":true,"price":"12.5"}'))
        .when((kind == "signup") & (k < 40), F.lit('{"id":"1","name":"x","price":"cheap"}'))
        .otherwise(body)
        .alias("payload"),
        F.pmod(k, F.lit(5)).cast("int").alias("retry_count"),
        k.alias("k"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded events; some bodies are cut off, carry an unknown key or a value of the wrong type."""
    return _messages(spark, sf_dir).drop("k")


def queue_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as they lie in the queues, bodies partly double-encoded."""
    rows = _messages(spark, sf_dir)
    quoted = F.concat(F.lit('"'), F.replace("payload", F.lit('"'), F.lit('\\"')), F.lit('"'))
    by_op = F.create_map(*[F.lit(v) for pair in S.QUEUE_OF_OP.items() for v in pair])[F.col("op")]
    return rows.select(
        "seq_ts",
        "seq_id",
        F.when(F.col("k") < 20, S.QUEUE_RETRY).when(F.col("k") < 40, S.QUEUE_DEAD).otherwise(by_op).alias("queue"),
        "op",
        F.when(F.col("retry_count") == 1, quoted)
        .when(F.col("retry_count") == 2, F.concat(F.lit("  "), "payload", F.lit(" \n")))
        .otherwise(F.col("payload"))
        .alias("payload"),
        "retry_count",
        F.when(F.col("k") < 20, F.col("seq_ts") + F.expr("interval 5 seconds")).alias("available_at"),
        F.when((F.col("k") >= 20) & (F.col("k") < 40), F.col("seq_ts")).alias("dead_at"),
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily catalog snapshots: (version, created_at, table_name, id, name, description, price)."""
    day = F.to_date("seq_ts")
    return changes(spark, sf_dir).select(
        F.dayofmonth(day).alias("version"),
        day.cast("timestamp_ntz").alias("created_at"),
        F.when(F.col("op") == S.DELETED, ".system").when(F.col("op") == S.CREATED, "labels").otherwise("products").alias("table_name"),
        "seq_id",
        "id",
        "name",
        "description",
        "price",
    )
