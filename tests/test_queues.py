import datetime as dt

from pyspark.sql import functions as F

from shelfmark import schemas as S
from shelfmark.operators import queues

NOW = dt.datetime(2024, 1, 20)
FIELDS = "seq_ts timestamp_ntz, seq_id int, op string, queue string, payload string, retry_count int, available_at timestamp_ntz, dead_at timestamp_ntz"


def queued(spark, rows):
    return spark.createDataFrame(rows, FIELDS)


def test_retry_three_times_then_dead(spark):
    failed = spark.createDataFrame([(n, n) for n in (0, 2, 3, 4)] + [(9, None)], "seq_id int, retry_count int")
    sent = {r["seq_id"]: r for r in queues.retry_or_dead(failed, F.lit(NOW).cast("timestamp_ntz")).collect()}
    assert [sent[i]["queue"] for i in (0, 2, 3, 4, 9)] == [S.QUEUE_RETRY] * 2 + [S.QUEUE_DEAD] * 2 + [S.QUEUE_RETRY]
    assert sent[0]["available_at"] == NOW + dt.timedelta(seconds=5) and sent[0]["retry_count"] == 1
    assert sent[9]["retry_count"] == 1
    assert sent[3]["dead_at"] == NOW and sent[3]["retry_count"] is None


def test_due_and_expired(spark):
    rows = [
        (NOW, 1, "DELETED", S.QUEUE_RETRY, "{}", 1, NOW, None),
        (NOW, 2, "CREATED", S.QUEUE_RETRY, "{}", 1, NOW + dt.timedelta(seconds=1), None),
        (NOW, 3, "CREATED", S.QUEUE_DEAD, "{}", None, None, NOW - dt.timedelta(days=14)),
        (NOW, 4, "CREATED", S.QUEUE_DEAD, "{}", None, None, NOW - dt.timedelta(days=14, seconds=-1)),
    ]
    as_of = F.lit(NOW).cast("timestamp_ntz")
    due = queues.due_retries(queued(spark, rows), as_of).collect()
    assert [(r["seq_id"], r["queue"]) for r in due] == [(1, S.QUEUE_DELETED)]
    assert {r["seq_id"] for r in queues.expire_dead(queued(spark, rows), as_of).collect()} == {1, 2, 4}


def test_reprocess_status_peek(spark):
    rows = [(NOW, i, "UPDATED", S.QUEUE_DEAD, '{"id": "%d"}' % i if i % 2 else "oops", None, None, NOW) for i in range(12)]
    rows += [(NOW, 100 + i, "UPDATED", S.QUEUE_UPDATED, "x", 0, None, None) for i in range(6)]
    table = queued(spark, rows)
    again = queues.reprocess_dead(table).collect()
    assert len(again) == 6 and {(r["op"], r["queue"]) for r in again} == {("CREATED", S.QUEUE_CREATED)}
    status = {r["queue"]: (r["messages"], r["level"]) for r in queues.status(table).collect()}
    assert status == {
        S.QUEUE_DEAD: (12, "high"),
        S.QUEUE_UPDATED: (6, "medium"),
        S.QUEUE_CREATED: (0, "none"),
        S.QUEUE_DELETED: (0, "none"),
        S.QUEUE_RETRY: (0, "none"),
    }
    head = queues.peek(table).collect()
    assert len(head) == 16
    assert {r["message"] for r in head if r["seq_id"] == 1} == {'{"id":"1"}'}
