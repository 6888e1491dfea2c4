"""Connected components of links between documents, fingerprints or hosts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.session import settle


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge list: (node, root), root being the smallest node.

    Two steps alternate until nothing changes: every node sends its larger neighbours to its smallest one, then its smaller
    neighbours. Components become stars in a number of rounds logarithmic in their size. Minima combine before their shuffle and
    are written down before edges meet them, so that adaptive execution can broadcast them or split a hub's edges over tasks.
    Edges with a null end and loops are ignored; nodes without another neighbour do not appear. No edges: no rows.
    """
    now = settle(edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before, mark = None, _mark(now)
    while mark[0] and mark != before:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        met = both.join(_least(both), "u").filter(F.col("v") > F.col("u"))
        large = settle(met.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
        ends = large.join(_least(large), "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        now = settle(ends.select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).filter("u != v").distinct())
        before, mark = mark, _mark(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _least(edges: DataFrame) -> DataFrame:
    return settle(edges.groupBy("u").agg(F.min("v").alias("m")))


def _mark(edges: DataFrame) -> tuple:
    """Row count and a checksum of a set of edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
