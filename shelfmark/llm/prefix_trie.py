"""Prefix trie of conversations by fixed-length block hashing.

A conversation's turns are cut into blocks of `BLOCK`. What a conversation says up to a turn is known by its length and two sums of
salted digests of its turns, so a block's key follows from the key before it, and conversations are first grouped by keys at block
ends only: one row for each distinct block that continues a prefix, with the number of conversations that take it. Where a prefix is
continued by a single block, all turns inside have the members of the block. Only where siblings diverge are the turns of the distinct
blocks, not of the conversations, grouped once more. The salt is new in every run, so no text can be made to collide.

A node belongs to its smallest member, so each conversation owns a chain: the nodes from where it parts from smaller ones down to its
end. Sums over subtrees are sums along chains plus the totals of the chains hung on them, and totals of a tree of chains are summed
by pointer doubling, in a number of rounds logarithmic in its height. Running sums along conversations and chains are cut by
ranges, so that a conversation of any length is spread over tasks. The ids that end in a node are joined in pieces of bounded
size by range; a digest reads its pieces one after another.

Rows without a conversation id are left out. A null role or text is empty; turns are ordered by number, null first, and equal
numbers by a digest of role and text, so repeated rows are turns of their own. An empty table has no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import Batches, on_executors, running
from shelfmark.operators import skew
from shelfmark.session import settle

#: Turns in a block.
BLOCK = 4
#: Hex digits of a turn's digest in each of the two sums: a block's sums stay below 64 bits.
WORD = 14
#: Bytes after which a piece of joined ids is handed on.
PIECE = 1 << 20
SUM = "decimal(38,0)"


def numbered(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns as (conv, depth, digest, bytes), depth counting from 1 in each conversation."""
    said = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text)]
    digest = F.sha2(F.concat(F.octet_length(said[0]).cast("string"), F.lit(":"), *said), 256)
    rows = turns.filter(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), digest.alias("digest"), F.octet_length(said[1]).cast("long").alias("bytes")
    )
    placed = skew.distributed_rank(rows, ["conv"], [F.col("turn").asc_nulls_first(), F.col("digest")], "depth")
    return settle(placed.select("conv", F.col("depth").cast("long").alias("depth"), "digest", "bytes"))


def lengths(steps: DataFrame) -> DataFrame:
    return settle(steps.groupBy("conv").agg(F.count("*").alias("length")))


def _blocks(steps: DataFrame) -> DataFrame:
    """(conv, block, p1, p2, turns): the key before the block and its turns with the keys before (p) and after (s) each."""
    salt = F.lit(uuid.uuid4().hex)
    salted = F.sha2(F.concat_ws(":", salt, F.col("depth").cast("string"), "digest"), 256)
    word = [F.conv(F.substr(salted, F.lit(1 + i * WORD), F.lit(WORD)), 16, 10).cast("long").alias(f"w{i + 1}") for i in (0, 1)]
    block = F.floor((F.col("depth") - 1) / BLOCK).cast("long").alias("block")
    cut = (
        steps.select("conv", block, F.struct("depth", *word, "bytes").alias("turn"))
        .groupBy("conv", "block")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))  # at most BLOCK of them
    )

    def upto(n: Column, w: str) -> Column:
        return F.aggregate(F.slice("turns", F.lit(1), n), F.lit(0).cast("long"), lambda s, t: s + t[w])

    whole = cut.select("conv", "block", "turns", *[upto(F.size("turns"), f"w{i}").cast(SUM).alias(f"e{i}") for i in (1, 2)])
    summed = running(whole.select("*", F.col("e1").alias("s1"), F.col("e2").alias("s2")), "conv", F.col("block").asc(), ["s1", "s2"])
    before = summed.select("conv", "block", "turns", *[(F.col(f"s{i}") - F.col(f"e{i}")).cast(SUM).alias(f"p{i}") for i in (1, 2)])

    def key(t: Column, i: Column) -> Column:
        sums = [(F.col(f"p{j}") + upto(i + n, f"w{j}")).cast(SUM).alias(f"{x}{j}") for x, n in (("p", 0), ("s", 1)) for j in (1, 2)]
        return F.struct(t["depth"].alias("depth"), *sums, t["bytes"].alias("bytes"))

    return before.withColumn("turns", F.transform("turns", key))


def _grouped(blocks: DataFrame) -> DataFrame:
    """Nodes below the root as (depth, s1, s2, p1, p2, conv, n, bytes, parent); parent is null where it is not known yet."""
    last = F.element_at("turns", -1)
    distinct = settle(
        blocks.groupBy("block", "p1", "p2", *[last[c].alias(f"end_{c}") for c in ("depth", "s1", "s2")]).agg(
            F.count("*").alias("n"), F.min("conv").alias("conv"), F.first("turns").alias("turns")
        )
    )
    alone = settle(
        distinct.groupBy("block", "p1", "p2")
        .agg(F.count("*").alias("siblings"), F.first(F.struct("conv", "n", "turns")).alias("only"))
        .filter(F.col("siblings") == 1)
        .select("block", "p1", "p2", "only.*")
    )
    columns = ["depth", "s1", "s2", "p1", "p2", "conv", "n", "bytes", "parent"]
    inner = alone.select("conv", "n", F.posexplode("turns").alias("at", "turn")).select(
        "turn.*", "conv", "n", F.when(F.col("at") > 0, F.col("conv")).alias("parent")
    )
    diverging = distinct.join(alone.select("block", "p1", "p2"), ["block", "p1", "p2"], "left_anti")
    refined = (
        diverging.select("conv", "n", F.explode("turns").alias("turn"))
        .select("conv", "n", "turn.*")
        .groupBy("depth", "s1", "s2")
        .agg(F.min("conv").alias("conv"), F.sum("n").alias("n"), *[F.first(c).alias(c) for c in ("p1", "p2", "bytes")])
        .withColumn("parent", F.lit(None).cast("long"))
    )
    return settle(inner.select(*columns).unionByName(refined.select(*columns)))


def _totals(chains: DataFrame) -> DataFrame:
    """(conv, above, saved, leaves) with the sums over all chains that hang on a chain, at any distance, added."""
    state = settle(chains)
    while not state.filter(F.col("above").isNotNull()).isEmpty():
        hanging = state.filter(F.col("above").isNotNull())
        more = hanging.groupBy("above").agg(F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"))
        further = hanging.select(F.col("conv").alias("above"), F.col("above").alias("next"))
        state = settle(
            state.join(more.withColumnRenamed("above", "conv"), "conv", "left")
            .join(further, "above", "left")
            .select(
                "conv",
                F.col("next").alias("above"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            )
        )
    return state.select("conv", "saved", "leaves")


def _pieces(batches: Batches, most: int) -> Batches:
    """Ids of sorted rows (conv, depth, member) joined by commas, cut where a node ends or a piece is full."""

    def piece(key: tuple, members: list[str], first: int) -> pa.RecordBatch:
        columns = [pa.array([x], pa.int64()) for x in (*key, first)] + [pa.array([",".join(members)], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["conv", "depth", "first", "ids"])

    key, members, first, size = None, [], 0, 0
    for batch in batches:
        for *now, member in zip(*(batch.column(c).to_pylist() for c in ("conv", "depth", "member"))):
            if tuple(now) != key or size > most:
                if key:
                    yield piece(key, members, first)
                key, members, first, size = tuple(now), [], member, 0
            members.append(str(member))
            size += len(members[-1]) + 1
    if key:
        yield piece(key, members, first)


def _hashed(batches: Batches) -> Batches:
    """The digest of each node's pieces, which come in order."""

    def result(key: tuple, digest: str) -> pa.RecordBatch:
        columns = [pa.array([x], pa.int64()) for x in key] + [pa.array([digest], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["conv", "depth", "ends_sha256"])

    key, state = None, hashlib.sha256()
    for batch in batches:
        for *now, ids in zip(*(batch.column(c).to_pylist() for c in ("conv", "depth", "ids"))):
            if tuple(now) == key:
                state.update(b",")
            else:
                if key:
                    yield result(key, state.hexdigest())
                key, state = tuple(now), hashlib.sha256()
            state.update(ids.encode())
    if key:
        yield result(key, state.hexdigest())


def _digests(ends: DataFrame) -> DataFrame:
    """(conv, depth, ends_sha256) of (conv, depth, member)."""
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["conv", "depth", "member"]
    sorted_ids = ends.select(*keys).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    pieces = on_executors(sorted_ids, partial(_pieces, most=PIECE), "conv long, depth long, first long, ids string")
    in_order = pieces.repartition(parts, "conv", "depth").sortWithinPartitions("conv", "depth", "first")
    return on_executors(in_order, _hashed, "conv long, depth long, ends_sha256 string")


def trie(convs: DataFrame, steps: DataFrame) -> DataFrame:
    """Nodes of the conversations `convs` (conv, length) with the turns `steps` (conv, depth, digest, bytes).

    One row for each distinct sequence of first turns: conv_id (its smallest member), depth, parent_conv_id (the parent's conv_id),
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n")).filter(F.col("n") > 0)
    blocks = settle(_blocks(steps))
    below = _grouped(blocks)
    zero = F.lit(0).cast(SUM)
    known = below.unionByName(
        root.select(F.lit(0).cast("long").alias("depth"), zero.alias("s1"), zero.alias("s2"), "conv", "n", F.lit(0).cast("long").alias("bytes")),
        allowMissingColumns=True,
    )
    keys = settle(known.select("depth", "s1", "s2", "conv"))
    upper = keys.select((F.col("depth") + 1).alias("depth"), F.col("s1").alias("p1"), F.col("s2").alias("p2"), F.col("conv").alias("up"))
    asking = below.filter(F.col("parent").isNull()).join(upper, ["depth", "p1", "p2"]).withColumn("parent", F.col("up"))
    columns = ["conv", "depth", "parent", "n", "bytes"]
    nodes = settle(
        below.filter(F.col("parent").isNotNull()).select(*columns).unionByName(asking.select(*columns)).unionByName(known.filter("depth = 0").select(*columns))
    )

    children = nodes.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth"))
    counted = settle(
        nodes.join(children.agg(F.count("*").alias("n_children")), ["conv", "depth"], "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
        .withColumns({"saved": (F.col("n") - 1) * F.col("bytes"), "leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")})
    )
    tops = counted.filter(F.col("parent").isNull() | (F.col("parent") != F.col("conv")))
    tops = settle(tops.select("conv", F.col("parent").alias("above"), (F.col("depth") - 1).alias("at")))
    own = counted.groupBy("conv").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    totals = _totals(tops.select("conv", "above").join(own, "conv"))
    hung = tops.filter(F.col("above").isNotNull()).join(totals, "conv").groupBy(F.col("above").alias("conv"), F.col("at").alias("depth"))
    hung = hung.agg(F.sum("saved").alias("hung_saved"), F.sum("leaves").alias("hung_leaves"))
    with_hung = counted.join(hung, ["conv", "depth"], "left").select(
        *counted.columns[:-2], *[(F.col(c) + F.coalesce(f"hung_{c}", F.lit(0))).alias(c) for c in ("saved", "leaves")]
    )
    summed = running(with_hung, "conv", F.col("depth").desc(), ["saved", "leaves"])

    last = F.element_at("turns", -1)
    tails = settle(blocks.groupBy("conv").agg(F.max_by(F.struct(last["depth"].alias("depth"), last["s1"].alias("s1"), last["s2"].alias("s2")), "block").alias("end")))
    turnless = convs.filter(F.col("length") == 0).select(F.col("conv").alias("member"), F.lit(0).cast("long").alias("depth"), zero.alias("s1"), zero.alias("s2"))
    ending = tails.select(F.col("conv").alias("member"), "end.*").unionByName(turnless)
    digests = settle(_digests(ending.join(keys, ["depth", "s1", "s2"])))
    return summed.join(digests, ["conv", "depth"], "left").select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie of conversations as they are."""
    steps = numbered(turns)
    return trie(lengths(steps), steps)


def rebuilt(steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The contract's conversations: the first h turns of the conversation whose id is the next lower multiple of 5, then the own
    ones after the first h; h is the CRC-32 of the decimal id modulo 9. Returns (conv, length) and the turns."""
    own = lengths(steps)
    named = own.select(
        "conv", "length", (F.col("conv") - F.col("conv") % 5).alias("base"), (F.crc32(F.col("conv").cast("string").cast("binary")) % 9).alias("h")
    )
    bases = own.select(F.col("conv").alias("base"), F.col("length").alias("base_length"))
    taken = F.least("h", F.coalesce("base_length", F.lit(0)))
    plans = settle(named.join(bases, "base", "left").select("conv", "length", "base", "h", taken.alias("taken")))
    rest = steps.join(plans.select("conv", "h", "taken"), "conv").filter(F.col("depth") > F.col("h"))
    kept = rest.select("conv", (F.col("depth") - F.col("h") + F.col("taken")).alias("depth"), "digest", "bytes")
    lent = (
        steps.filter(F.col("depth") <= 8)
        .withColumnRenamed("conv", "base")
        .join(plans.select("base", "conv", "h"), "base")
        .filter(F.col("depth") <= F.col("h"))
        .select("conv", "depth", "digest", "bytes")
    )
    whole = plans.select("conv", (F.col("taken") + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("length"))
    return settle(whole), settle(lent.unionByName(kept))


def report(turns: DataFrame) -> DataFrame:
    """The contract of op13."""
    return trie(*rebuilt(numbered(turns)))
