"""Connected components by alternating large-star and small-star.

Each round is two joins of the edges with the smallest neighbour of every node. The
minima are combined on the map side and staged, so that the join with them is a plain
two-sided shuffle (or a broadcast, when Spark finds them small): a node that has a third
of all edges is split by adaptive execution. No link or component is held on the driver,
which only compares a row count and a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytide.llm.frames import staged


def _pointed(edges: DataFrame, minima: DataFrame) -> DataFrame:
    """Edges `(u, v)` with `v` linked to the smallest neighbour of `u` instead."""
    return edges.join(minima, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _links(edges: DataFrame) -> DataFrame:
    """Each link once, from the larger node `u` to the smaller `v`."""
    return (
        edges.filter("u != v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .groupBy("u", "v")
        .agg(F.lit(1).alias("one"))
        .select("u", "v")
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    minima = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    return _links(_pointed(both.filter("v > u"), minima))


def _small_star(edges: DataFrame) -> DataFrame:
    minima = staged(edges.groupBy("u").agg(F.min("v").alias("m")))
    return _links(_pointed(edges, minima).union(minima.select("u", F.col("m").alias("v"))))


def _mark(edges: DataFrame) -> tuple:
    """Row count and an order-free checksum; sums in decimal cannot overflow."""
    return tuple(
        edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("sum"),
        ).first()
    )


def connected_components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """`(node, component)` of every linked node: the smallest node it is linked to.

    Nodes are of any ordered type of their own (long here); loops and repeated links do
    no harm, a link with a null end is no link. No links give no rows.
    """
    rows = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).dropna()
    now = staged(_links(rows))
    mark = _mark(now)
    while mark[0]:
        now = staged(_small_star(staged(_large_star(now))))
        before, mark = mark, _mark(now)
        if mark == before:
            break
    # A finished star: every node points at its smallest, which points nowhere.
    centres = now.groupBy("v").agg(F.lit(1).alias("one")).select(F.col("v").alias("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        centres.select("node", F.col("node").alias("component"))
    )
