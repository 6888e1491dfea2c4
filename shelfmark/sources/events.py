"""Change events as JSON messages: strict encoding and decoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import schemas as S


def _by_op(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(v) for pair in values.items() for v in pair])[F.col("op")]


def encode(changes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(seq_ts, seq_id, id, op, queue, routing_key, payload) and columns to keep; a DELETED body has no price."""
    keep_nulls = {"ignoreNullFields": "false"}
    full = F.to_json(F.struct("id", "name", "description", "price"), keep_nulls)
    short = F.to_json(F.struct("id", "name", "description"), keep_nulls)
    return changes.select(
        "seq_ts",
        "seq_id",
        "id",
        "op",
        _by_op(S.QUEUE_OF_OP).alias("queue"),
        _by_op(S.ROUTING_KEY_OF_OP).alias("routing_key"),
        F.when(F.col("op") == S.DELETED, short).otherwise(full).alias("payload"),
        *keep,
    )


def _literal_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def decode(messages: DataFrame) -> DataFrame:
    """Add id, name, description, price and `error`; a row with an error carries no values.

    The reader is strict: a malformed body, a key the event does not define, an object or array where a plain value belongs,
    a missing id, a price that is not a number in range and a time that is none are errors.
    """
    body = F.col("payload")
    keys = F.json_object_keys(body)
    allowed = F.when(F.col("op") == S.DELETED, _literal_array(S.DELETED_KEYS)).otherwise(
        _literal_array(S.DOCUMENT_KEYS)
    )
    value = {name: F.get_json_object(body, f"$.{name}") for name in ("id", "name", "description", "price")}
    price = value["price"].try_cast(S.PRICE)
    parsed = F.try_parse_json(body)
    nested = F.schema_of_variant(parsed).rlike("^OBJECT<.*(OBJECT|ARRAY)<")
    badly_timed = F.lit(False)
    for name in S.TIME_KEYS:
        text = F.get_json_object(body, f"$.{name}")
        badly_timed |= text.isNotNull() & text.try_cast("timestamp").isNull()
    error = (
        F.when(keys.isNull() | parsed.isNull(), "malformed")
        .when(F.size(F.array_except(keys, allowed)) > 0, "unknown key")
        .when(nested, "bad type")
        .when(value["id"].isNull(), "missing id")
        .when(value["price"].isNotNull() & price.isNull(), "bad price")
        .when(badly_timed, "bad time")
    )
    fields = {"id": value["id"], "name": value["name"], "description": value["description"], "price": price}
    decoded = messages.withColumn("error", error)
    return decoded.select(
        *messages.columns,
        "error",
        *[F.when(F.col("error").isNull(), column).alias(name) for name, column in fields.items()],
    )


def read_seed(spark, path: str, lines: bool = False) -> DataFrame:
    """Seed products in their order: (name, description, price, position).

    A file, or a folder of files, each a JSON array of {name, description, price}, or with `lines` JSON lines, which
    Spark can also split. An array is read by one task.
    """
    rows = spark.read.schema(S.SEED).option("multiLine", not lines).json(path)
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return rows.withColumn("position", place)
