"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.session import settle


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge list: (node, root), root being the smallest node.

    Alternates two steps until nothing changes: every node sends its larger neighbours to its smallest one,
    then its smaller neighbours. Components shrink to stars in a number of rounds logarithmic in their size, and
    no step holds the neighbours of a node together: minima combine before the shuffle, and a hub's edges are
    only joined with its one minimum. Each round is written down, so that its lineage ends there. Edges with a
    null end and loops are ignored; nodes without another neighbour do not appear. No edges: no rows.
    """
    now = _settled(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a) != F.col(b)))
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u")
            .filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
        )
        now = _settled(small.select("u", "v", F.col("u") != F.col("v")))
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _settled(edges: DataFrame) -> DataFrame:
    u, v, differ = edges.columns
    return settle(edges.filter(F.col(differ)).select(u, v).distinct())


def _mark(edges: DataFrame) -> tuple:
    """Row count and a checksum of a set of edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
