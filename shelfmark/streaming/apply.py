"""Continuous application of the message feed to a bucketed catalog.

The catalog is split into buckets by product id, and a table of the keys that products hold into buckets by key. A micro-batch
reads and rewrites only the buckets it touches, as `version=<batch>/bucket=<b>`. Messages that cannot be read become pending
retries, rewritten by every batch, or dead letters, which are only added, one folder a day and batch, and
removed by whole days. With `indexed`, each batch also adds a segment to the search index, from the products it has messages
for; the commit file lists the segments, so catalog and index are always of the same batch. A batch counts once its commit file exists. That file holds everything the next batch must know: the
version of each bucket, the layout and the time, so no folder is searched for older versions. A replayed batch is skipped,
and the result of one does not depend on how often it was tried.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import schemas as S
from shelfmark.functions.text import normalized_key
from shelfmark.operators import changes, queues, uniqueness
from shelfmark.operators.products import search_columns
from shelfmark.session import settle
from shelfmark.sources import events
from shelfmark.sources.segments import Segments
from shelfmark.sources.versions import children, delete, numbered, read_text, write_text

DOCUMENT = T.StructType(
    [
        *S.PRODUCT.fields,
        T.StructField("updatedAt", T.TimestampNTZType()),
        T.StructField("priceChangedAt", T.TimestampNTZType()),
        T.StructField("normalizedKey", T.StringType()),
    ]
)
HELD = T.StructType([T.StructField("key", T.StringType()), T.StructField("id", T.StringType())])
QUEUED = T.StructType(
    [
        *S.MESSAGE.fields,
        T.StructField("error", T.StringType()),
        T.StructField("queue", T.StringType()),
        T.StructField("available_at", T.TimestampNTZType()),
        T.StructField("dead_at", T.TimestampNTZType()),
    ]
)
NO_DAY = "unknown"
BUCKETS = 16

MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _key() -> Column:
    return normalized_key(F.col("name"), F.col("description"))


def write_feed(messages: DataFrame, path: str) -> None:
    """Append messages as JSON lines, as the file source of `run` reads them."""
    messages.select(*S.MESSAGE.names).write.mode("append").option("timestampNTZFormat", MICROS).json(path)


class StreamApply:
    """The stored catalog and queue below `base`.

    Choose `buckets` so that a micro-batch leaves many of them untouched, and `files` per bucket so that one
    file fits a task. The first batch stores the number of buckets, and whether there is an index; opening the store with
    another number, or an index it was not begun with, is refused.
    """

    def __init__(
        self,
        spark: SparkSession,
        base: str,
        buckets: int | None = None,
        files: int = 1,
        hot_rows: int | None = None,
        indexed: bool | None = None,
    ):
        self.spark, self.base, self.files, self.hot_rows = spark, base, files, hot_rows
        state = self._state()
        stored = state.get("buckets")
        if buckets and stored and buckets != stored:
            raise ValueError(f"{base} is stored in {stored} buckets, not in {buckets}")
        if indexed and state and "index" not in state:
            raise ValueError(f"{base} was begun without a search index")
        self.buckets = stored or buckets or BUCKETS
        self.indexed = "index" in state if state else bool(indexed)

    # --- stored state ---

    def _state(self, before: int | None = None) -> dict:
        """What the newest commit (before a batch) says; empty before the first."""
        done = [int(n) for n in children(self.spark, f"{self.base}/commits") if n.isdigit()]
        done = [n for n in done if before is None or n < before]
        return json.loads(read_text(self.spark, f"{self.base}/commits/{max(done)}")) if done else {}

    def _commit(self, batch: int, state: dict, old: dict) -> None:
        """Make the batch count, then remove what the batch before it has replaced."""
        write_text(self.spark, f"{self.base}/commits/{batch}", json.dumps(state))
        for path in [*old.get("replaced", []), *([f"commits/{old['replaces']}"] if "replaces" in old else [])]:
            delete(self.spark, f"{self.base}/{path}")

    def _read(self, name: str, schema: T.StructType, versions: dict[str, int], buckets: set[int] | None = None) -> DataFrame:
        paths = [
            f"{self.base}/{name}/version={v}/bucket={b}"
            for b, v in sorted(versions.items())
            if buckets is None or int(b) in buckets
        ]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _write(self, name: str, rows: DataFrame, by: str, batch: int, versions: dict, touched: set[int]) -> tuple[dict, list[str]]:
        """Write the touched buckets; returns the new version of each bucket, and the folders this replaces."""
        part = F.pmod(F.hash("id"), F.lit(self.files))
        path = f"{self.base}/{name}/version={batch}"
        bucketed = rows.withColumn("bucket", self._bucket(by)).repartition("bucket", part)
        bucketed.write.mode("overwrite").partitionBy("bucket").parquet(path)
        filled = set(numbered(self.spark, path, "bucket"))
        new = {b: v for b, v in versions.items() if int(b) not in touched} | {str(b): batch for b in filled}
        gone = {b: v for b, v in versions.items() if int(b) in touched}
        unused = set(gone.values()) - set(new.values())
        replaced = [f"{name}/version={v}" for v in unused | ({batch} if not filled else set())]
        replaced += [f"{name}/version={v}/bucket={b}" for b, v in gone.items() if v not in unused]
        return new, sorted(replaced)

    def _bucket(self, by: str) -> Column:
        return F.pmod(F.xxhash64(by), F.lit(self.buckets)).cast("int")

    def _buckets_of(self, rows: DataFrame, by: str) -> set[int]:
        return {r["bucket"] for r in rows.select(self._bucket(by).alias("bucket")).distinct().collect()}

    def catalog(self) -> DataFrame:
        """The current catalog."""
        return self._read("catalog", DOCUMENT, self._state().get("catalog", {})).drop("normalizedKey")

    def _index(self, state: dict) -> Segments:
        return Segments(self.spark, f"{self.base}/index", **state.get("index", {}))

    def searchable(self) -> tuple[DataFrame, Segments]:
        """The search documents of the current catalog and their index, both of the last commit."""
        state = self._state()
        if "index" not in state:
            raise ValueError(f"{self.base} has no search index")
        return search_columns(self._read("catalog", DOCUMENT, state["catalog"])), self._index(state)

    def _retries(self, state: dict) -> DataFrame:
        if "batch" not in state:
            return self.spark.createDataFrame([], QUEUED)
        return self.spark.read.schema(QUEUED).parquet(f"{self.base}/retry/version={state['batch']}")

    def queue(self) -> DataFrame:
        """Pending retries and dead letters after the last batch."""
        state = self._state()
        dead = self.spark.createDataFrame([], QUEUED)
        if children(self.spark, f"{self.base}/dead"):
            stored = T.StructType([*QUEUED.fields, T.StructField("day", T.StringType()), T.StructField("batch", T.LongType())])
            dead = self.spark.read.schema(stored).parquet(f"{self.base}/dead").filter(F.col("batch") <= state.get("batch", -1))
        kept = queues.expire_dead(dead.select(*QUEUED.names), _time(state.get("as_of")))
        return self._retries(state).unionByName(kept)

    # --- one micro-batch ---

    def apply(self, messages: DataFrame, batch: int) -> None:
        if messages.sparkSession is not self.spark:  # a stream hands out batches of its own session
            StreamApply(messages.sparkSession, self.base, self.buckets, self.files, self.hot_rows, self.indexed).apply(messages, batch)
            return
        if batch <= self._state().get("batch", -1):
            return
        old = self._state(batch)
        new = messages.select(*S.MESSAGE.names)
        # The time of the feed never goes back, and a batch without any keeps the last one.
        latest = new.agg(F.max("seq_ts").cast("string").alias("at")).first()["at"]
        times = [dt.datetime.fromisoformat(t) for t in (latest, old.get("as_of")) if t]
        now = str(max(times)) if times else None
        as_of = _time(now)
        waiting = self._retries(old)
        due = F.coalesce(F.col("available_at") <= as_of, F.col("available_at").isNull())
        decoded = settle(events.decode(new.unionByName(waiting.filter(due).select(*S.MESSAGE.names))))

        failed = queues.retry_or_dead(decoded.filter(F.col("error").isNotNull()), as_of).select(*QUEUED.names)
        is_dead = F.col("queue") == S.QUEUE_DEAD
        retries = waiting.filter(~due).unionByName(failed.filter(~is_dead))
        retries.write.mode("overwrite").parquet(f"{self.base}/retry/version={batch}")
        day = F.coalesce(F.to_date("dead_at").cast("string"), F.lit(NO_DAY))
        dead = failed.filter(is_dead).withColumns({"day": day, "batch": F.lit(batch)})
        dead = dead.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch")
        dead.parquet(f"{self.base}/dead")

        state = {"batch": batch, "as_of": now, "buckets": self.buckets, "catalog": {}, "keys": {}} | {
            name: old[name] for name in ("catalog", "keys") if name in old
        }
        if self.indexed:
            state["index"] = old.get("index", {"live": [], "bounds": []})
        replaced = [f"retry/version={old['batch']}"] if old else []
        feed = decoded.filter(F.col("error").isNull()).select(*S.CHANGE.names)
        touched = self._buckets_of(feed, "id")
        if touched:
            before = self._read("catalog", DOCUMENT, state["catalog"], touched)
            created = feed.filter(F.col("op") == S.CREATED).select(_key().alias("key")).distinct()
            held = self._read("keys", HELD, state["keys"], self._buckets_of(created, "key"))
            others = held.filter(~self._bucket("id").isin(touched)).join(created, "key", "left_semi").select("key")
            rejected = uniqueness.key_conflicts(feed, before.drop("normalizedKey"), others, self.hot_rows)
            after = changes.fold(feed, before.drop("normalizedKey"), self.hot_rows, rejected)
            after = settle(after.withColumn("normalizedKey", _key()).select(*DOCUMENT.names))
            state["catalog"], gone = self._write("catalog", after, "id", batch, state["catalog"], touched)
            replaced += gone
            if self.indexed:
                state["index"], gone = self._indexed(feed, after, before, batch, state)
                replaced += gone

            holds, held_before = (rows.select(F.col("normalizedKey").alias("key"), "id") for rows in (after, before))
            gained = settle(holds.join(held_before, ["key", "id"], "left_anti"))
            lost = settle(held_before.join(holds, ["key", "id"], "left_anti"))
            moved = self._buckets_of(gained.unionByName(lost), "key")
            if moved:
                rest = self._read("keys", HELD, state["keys"], moved).join(lost, ["key", "id"], "left_anti")
                state["keys"], gone = self._write("keys", rest.unionByName(gained), "key", batch, state["keys"], moved)
                replaced += gone
        state |= {"replaced": replaced + self._expired_days(now)} | ({"replaces": old["batch"]} if old else {})
        self._commit(batch, state, old)

    def _indexed(self, feed: DataFrame, after: DataFrame, before: DataFrame, batch: int, state: dict) -> tuple[dict, list[str]]:
        """Add the products that the batch has messages for to the index: its new state, and the folders this replaces."""
        named = settle(feed.select("id").distinct())
        now, then = (settle(search_columns(rows.join(named, "id", "left_semi"))) for rows in (after, before))
        index, replaced = self._index(state).add(batch, now, then, now.count())
        return {"live": index.live, "bounds": index.bounds}, [f"index/{path}" for path in replaced]

    def _expired_days(self, now: str | None) -> list[str]:
        """Folders of dead letters whose whole day is past the time to live."""
        if now is None:
            return []
        first = dt.datetime.fromisoformat(now).date() - dt.timedelta(days=S.DEAD_LETTER_DAYS)
        names = [n for n in children(self.spark, f"{self.base}/dead") if n.startswith("day=") and n != f"day={NO_DAY}"]
        return [f"dead/{n}" for n in names if dt.date.fromisoformat(n.removeprefix("day=")) < first]

    # --- the stream ---

    def run(self, feed_path: str, progress_path: str, files_per_batch: int | None = None) -> None:
        """Apply all messages that have arrived at `feed_path` and stop."""
        source = self.spark.readStream.schema(S.MESSAGE).option("timestampNTZFormat", MICROS)
        if files_per_batch:
            source = source.option("maxFilesPerTrigger", files_per_batch)
        writer = (
            source.json(feed_path)
            .writeStream.option("checkpointLocation", progress_path)
            .trigger(availableNow=True)
            .foreachBatch(lambda df, batch: self.apply(df, batch))
        )
        writer.start().awaitTermination()


def _time(value: str | None) -> Column:
    return F.lit(value).cast("timestamp_ntz")
