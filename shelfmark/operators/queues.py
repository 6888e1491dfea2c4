"""Queues as tables: routing, retry, expiry, reprocessing, counts and peeking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import schemas as S
from shelfmark.functions import messages as msg
from shelfmark.operators import skew


def route(events: DataFrame) -> DataFrame:
    """Add the queue and routing key of each event's operation."""
    pairs = lambda d: F.create_map(*[F.lit(v) for pair in d.items() for v in pair])
    return events.withColumns(
        {"queue": pairs(S.QUEUE_OF_OP)[F.col("op")], "routing_key": pairs(S.ROUTING_KEY_OF_OP)[F.col("op")]}
    )


def retry_or_dead(failed: DataFrame, at: Column) -> DataFrame:
    """Send a failed message to the retry queue, or to the dead queue once its attempts are used up."""
    tries = F.coalesce("retry_count", F.lit(0))
    dead = tries >= S.MAX_ATTEMPTS
    delay = F.expr(f"interval {S.RETRY_DELAY_SECONDS} seconds")
    return failed.withColumns(
        {
            "queue": F.when(dead, S.QUEUE_DEAD).otherwise(S.QUEUE_RETRY),
            "retry_count": F.when(~dead, tries + 1),
            "available_at": F.when(~dead, at + delay),
            "dead_at": F.when(dead, at),
        }
    )


def due_retries(queued: DataFrame, as_of: Column) -> DataFrame:
    """Retry messages whose delay has passed, back in the queue of their own operation."""
    due = queued.filter((F.col("queue") == S.QUEUE_RETRY) & (F.col("available_at") <= as_of))
    return route(due)


def expire_dead(queued: DataFrame, as_of: Column) -> DataFrame:
    """All messages but the dead ones certainly past their time to live: an unknown time expires nothing."""
    limit = as_of - F.expr(f"interval {S.DEAD_LETTER_DAYS} days")
    expired = (F.col("queue") == S.QUEUE_DEAD) & (F.col("dead_at") <= limit)
    return queued.filter(~F.coalesce(expired, F.lit(False)))


def reprocess_dead(queued: DataFrame) -> DataFrame:
    """Dead messages with a valid body, re-emitted as CREATED."""
    dead = queued.filter(F.col("queue") == S.QUEUE_DEAD).withColumn(
        "payload", msg.normalize_message(F.col("payload"))
    )
    valid = dead.filter(msg.parses(F.col("payload")))
    return route(valid.withColumn("op", F.lit(S.CREATED)))


def status(queued: DataFrame) -> DataFrame:
    """(queue, messages, level) for all five queues, empty ones included."""
    spark = queued.sparkSession
    queues = spark.createDataFrame([(q,) for q in S.QUEUES], "queue string")
    counts = queued.groupBy("queue").agg(F.count("*").alias("messages"))
    messages = F.coalesce("messages", F.lit(0))
    level = F.when(messages > 10, "high").when(messages > 5, "medium").when(messages > 0, "low").otherwise("none")
    return queues.join(counts, "queue", "left").select("queue", messages.alias("messages"), level.alias("level"))


def peek(queued: DataFrame, limit: int = 10) -> DataFrame:
    """The first messages of each queue with readable bodies; nothing is consumed."""
    order = [F.col("seq_ts"), F.col("seq_id")]
    head = skew.top_k(
        queued.select("queue", "seq_ts", "seq_id", "payload"), ["queue"], order, limit, ["seq_id"], rank="position"
    )
    return head.select(
        "queue",
        "position",
        "seq_id",
        msg.normalize_message(msg.tidy_message(F.col("payload"))).alias("message"),
    )
