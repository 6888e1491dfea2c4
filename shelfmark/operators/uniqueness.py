"""Which CREATED events of an ordered feed lose because their normalised key is taken.

A product holds a key from the event that gave it the key to its next UPDATED or DELETED event. Those ends are
known before it is decided which CREATED events are applied, because only they are ever ignored. A CREATED event
can only matter while its id is not alive for sure; call such a stretch a gap. Within a gap, and within the time
a key is held, the earliest event wins: greedy selection in feed order, decided in rounds. A round accepts every
event that no undecided earlier one can still beat and drops those that have lost; usually few rounds are needed. What a
fixed number of rounds leaves undecided, long chains of events that wait for each other, falls into connected groups of
keys and gaps, and each group is decided in feed order by itself: a slice of its events at a time, so that a task holds no more
than a slice. What a slice leaves behind, the time to which each key is held and the gaps that are filled, is joined with the next.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark import schemas as S
from shelfmark.functions.text import normalized_key
from shelfmark.operators import changes as ch
from shelfmark.operators import skew
from shelfmark.operators.components import components
from shelfmark.session import settle

_BEFORE = (Window.unboundedPreceding, -1)
ROUNDS = 6
#: Events of one connected group that a task decides at a time.
SLICE = 200_000
_EARLIEST = -(2**63)


def _latest_end(spans: DataFrame, end: Column, name: str, chunked: bool) -> DataFrame:
    """Add the greatest `end` among earlier spans of the same key."""
    spans = spans.withColumn("_end", end)
    inside = Window.partitionBy("key", "chunk").orderBy("seq_ts", "seq_id").rowsBetween(*_BEFORE)
    spans = spans.withColumn(name, F.max("_end").over(inside))
    if chunked:
        ends = spans.filter("hot").groupBy("key", "chunk").agg(F.max("_end").alias("_last"))
        across = Window.partitionBy("key").orderBy("chunk").rowsBetween(*_BEFORE)
        carried = ends.withColumn("_carried", F.max("_last").over(across)).drop("_last")
        spans = spans.join(carried, ["key", "chunk"], "left")
        spans = spans.withColumn(name, F.greatest(name, "_carried")).drop("_carried")
    return spans.drop("_end")


def _spans(
    feed: DataFrame, catalog: DataFrame | None, others: DataFrame | None, hot_rows: int | None
) -> DataFrame:
    """(key, seq_ts, seq_id, until, gap): key holders, with gap null, and CREATED events in a gap of their id."""
    line, chunked = ch.timeline(feed, catalog, hot_rows)
    op = F.col("op")
    certain = op != S.CREATED
    line = ch.carry(line, F.when(certain, F.struct("op", "seq_ts", "seq_id")), "since", chunked)
    line = ch.carry(line, F.when(certain, ch.position()), "until", chunked, backwards=True)
    in_gap = (op == S.CREATED) & F.coalesce(F.col("since.op") == S.DELETED, F.lit(True))
    gap = F.struct("id", F.col("since.seq_ts").alias("since_ts"), F.col("since.seq_id").alias("since_id"))
    spans = line.filter(in_gap | op.isin(S.UPDATED, ch.SNAPSHOT)).select(
        normalized_key(F.col("name"), F.col("description")).alias("key"),
        "seq_ts",
        "seq_id",
        F.coalesce("until", ch.forever()).alias("until"),
        F.when(in_gap, gap).alias("gap"),
    )
    from_start = spans.filter("seq_id is null").select("key", "until")
    if others is not None:
        from_start = from_start.unionByName(others.select("key", ch.forever().alias("until")))
    held = from_start.groupBy("key").agg(F.max("until").alias("until"))
    return spans.filter("seq_id is not null").unionByName(held, allowMissingColumns=True)


def key_conflicts(
    feed: DataFrame,
    catalog: DataFrame | None = None,
    others: DataFrame | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """(seq_id) of the CREATED events whose key another product holds at their turn.

    `others` may name keys held throughout by products outside the given catalog: (key).
    """
    spans = settle(_spans(feed, catalog, others, hot_rows))
    bounds = skew.hot_key_bounds(spans.filter("seq_id is not null"), "key", "seq_ts", hot_rows)
    spans, chunked = skew.chunk_of(spans, "key", "seq_ts", bounds), bounds is not None

    holder = F.col("gap").isNull()
    spans = _latest_end(spans, F.when(holder, F.col("until")), "taken", chunked).filter(~holder)
    lost = F.coalesce(F.col("taken") > ch.position(), F.lit(False))
    judged = settle(spans.withColumn("lost", lost).drop("taken"))
    losers = [judged.filter("lost").select("seq_id")]
    waiting = judged.filter("not lost").drop("lost")
    accepted = waiting.limit(0)

    rounds = 0
    while not waiting.isEmpty():
        if rounds == ROUNDS:
            losers.append(_in_order(waiting, accepted))
            break
        rounds += 1
        both = waiting.withColumn("won", F.lit(False)).unionByName(accepted.withColumn("won", F.lit(True)))
        both = _latest_end(both, F.when(F.col("won"), F.col("until")), "taken", chunked)
        both = _latest_end(both, F.when(~F.col("won"), F.col("until")), "maybe", chunked)
        clear = F.coalesce(F.col("maybe") <= ch.position(), F.lit(True))
        judged = settle(
            both.filter("not won").withColumns({"lost": lost, "clear": clear}).drop("taken", "maybe", "won")
        )
        losers.append(judged.filter("lost").select("seq_id"))
        rest = judged.filter("not lost").drop("lost")
        first = skew.first_per_key(rest, ["gap"], ["seq_ts", "seq_id"]).filter("clear").drop("clear")
        winners = settle(first.select(*accepted.columns))
        accepted = accepted.unionByName(winners)
        filled = winners.select("gap", F.lit(True).alias("_filled"))
        rest = skew.join(rest.drop("clear"), filled, ["gap"], "left")
        waiting = rest.filter("_filled is null").drop("_filled")
    return reduce(DataFrame.unionByName, losers)


def _in_order(waiting: DataFrame, accepted: DataFrame) -> DataFrame:
    """(seq_id) of the waiting events that lose, decided one by one within each connected group of keys and gaps.

    Pass n decides slice n of every group. There are as many passes as the largest group has slices, and groups go side by side.
    """
    places = {
        "at_ts": F.unix_micros(F.col("seq_ts").cast("timestamp")),
        "until_ts": F.unix_micros(F.col("until.seq_ts").cast("timestamp")),
        "until_id": F.col("until.seq_id"),
        "slot": F.concat(F.lit("gap "), F.to_json("gap")),
        "node": F.concat(F.lit("key "), F.col("key")),
    }
    columns = ["node", "slot", "at_ts", "seq_id", "until_ts", "until_id", "won"]
    undecided = settle(waiting.withColumns(places).withColumn("won", F.lit(False)).select(*columns))
    groups = components(undecided, "node", "slot")
    group_of = settle(groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct()))
    holders = accepted.withColumns(places).withColumn("won", F.lit(True)).select(*columns)
    events = skew.join(undecided.unionByName(holders), group_of, ["node"])  # holders of other keys find no group
    sliced = _slices(events)
    last = sliced.agg(F.max("last")).first()[0] or 0
    state, losers = None, []
    for n in range(last + 1):
        rows = _recalled(sliced.filter(F.col("slice") == n), state)
        schema = "seq_id long, lost boolean, node string, slot string, until_ts long, until_id long, last long"
        decided = settle(rows.groupBy("root").applyInPandas(_decide, schema))
        losers.append(decided.filter("lost").select("seq_id"))
        if n < last:
            state = _remembered(state, decided, n)
    return reduce(DataFrame.unionByName, losers)


def _slices(events: DataFrame) -> DataFrame:
    """Add `slice`, by the place of an event in its group, and `last`, the group's last one. Sorted by slice, so that a pass reads its own files."""
    ranked = skew.distributed_rank(events, ["root"], [F.col("at_ts"), F.col("seq_id")], "place")
    ranked = ranked.withColumn("slice", F.expr(f"(place - 1) div {SLICE}"))
    ends = settle(ranked.groupBy("root").agg(F.max("slice").alias("last")))
    return settle(skew.join(ranked, ends, ["root"]).repartitionByRange("slice", "root", "place").drop("place"))


def _recalled(rows: DataFrame, state: DataFrame | None) -> DataFrame:
    """Add the time to which an event's key is held by earlier slices; events of a filled gap go."""
    if state is None:
        return rows.withColumns({"held_ts": F.lit(_EARLIEST), "held_id": F.lit(_EARLIEST)})
    filled = state.select(F.col("name").alias("slot"), F.lit(True).alias("_filled"))
    held = {f"held_{c}": F.coalesce(f"_held.until_{c}", F.lit(_EARLIEST)) for c in ("ts", "id")}
    rows = skew.join(rows, filled, ["slot"], "left").filter("won OR _filled IS NULL").drop("_filled")
    rows = skew.join(rows, state.select(F.col("name").alias("node"), F.col("held").alias("_held")), ["node"], "left")
    return rows.withColumns(held).drop("_held")


def _remembered(state: DataFrame | None, decided: DataFrame, n: int) -> DataFrame:
    """(name, last, held) of the keys and gaps that slices up to n have taken, for groups that go on."""
    until = F.struct("until_ts", "until_id")
    names = F.explode(F.array("node", "slot")).alias("name")
    taken = decided.filter("not lost").select(names, "last", until.alias("held"))
    taken = taken if state is None else taken.unionByName(state)
    return settle(taken.filter(F.col("last") > n).groupBy("name", "last").agg(F.max("held").alias("held")))


def _decide(events: pd.DataFrame) -> pd.DataFrame:
    """The losers and winners among the events of a slice, one by one in feed order."""
    taken: dict[str, tuple[int, int]] = {}
    filled, out = set(), []
    for e in events.sort_values(["at_ts", "seq_id"]).itertuples():
        until, held = (e.until_ts, e.until_id), max(taken.get(e.node, (_EARLIEST, _EARLIEST)), (e.held_ts, e.held_id))
        lost = not e.won and held > (e.at_ts, e.seq_id)
        if not lost and (e.won or e.slot not in filled):
            taken[e.node] = max(until, held)
            filled.add(e.slot)
        elif not lost:
            continue
        out.append((e.seq_id, lost, e.node, e.slot, *until, e.last))
    return pd.DataFrame(out, columns=["seq_id", "lost", "node", "slot", "until_ts", "until_id", "last"])


def annotate_unique(feed: DataFrame, catalog: DataFrame | None = None, hot_rows: int | None = None) -> DataFrame:
    """As changes.annotate, with CREATED events ignored when their key is taken."""
    return ch.annotate(feed, catalog, hot_rows, key_conflicts(feed, catalog, hot_rows=hot_rows))


def fold_unique(feed: DataFrame, catalog: DataFrame | None = None, hot_rows: int | None = None) -> DataFrame:
    """The catalog after the feed, with CREATED events ignored when their key is taken."""
    return ch.catalog_of(annotate_unique(feed, catalog, hot_rows))


def apply_created(batch: DataFrame, catalog: DataFrame) -> DataFrame:
    """(seq_id, id, op, outcome) of CREATED events: created, ignored_id or ignored_key."""
    return ch.outcomes(annotate_unique(batch.filter(F.col("op") == S.CREATED), catalog))
