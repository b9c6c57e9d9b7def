"""Connected components of an edge table by alternating stars, in DataFrame operations only.

Each half round replaces edges so that components stay what they are: a large star links a node's larger neighbours to its
smallest one, a small star links its smaller neighbours and itself to the smallest. The number of rounds grows with the
logarithm of the longest path squared at worst, two or three for star-like input. Minima are combined before the shuffle; in large
input joins are between written tables, so that a hub's rows can be split over tasks. Every half round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.session import cut


#: Up to so many nodes a half round is one job; beyond, minima are written first so that the join can split hubs.
ONE_JOB = 1_000_000


def _star(edges: DataFrame, larger: bool, nodes: int) -> DataFrame:
    """One half round on edges (u, v) with v < u."""
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    near = edges.unionByName(back) if larger else edges
    lowest = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    lowest = lowest if nodes <= ONE_JOB else cut(lowest)
    if larger:
        linked = back.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = edges.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        linked = lowest.select("u", F.col("m").alias("v")).unionByName(moved)
    return cut(linked.distinct())


def _state(edges: DataFrame) -> tuple[bool, int]:
    """Whether every edge goes from a leaf to a root, and the number of nodes."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("child"), F.lit(0).alias("root")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("child"), F.lit(1).alias("root")))
    uses = ends.groupBy("id").agg(F.sum("child").alias("child"), F.max("root").alias("root"))
    odd = (F.col("child") > 1) | ((F.col("child") > 0) & (F.col("root") > 0))
    got = uses.agg(F.max(odd.cast("int")).alias("odd"), F.count(F.lit(1)).alias("n")).first()
    return not got["odd"], got["n"]


def components(edges: DataFrame) -> DataFrame:
    """(id, label) for every node of `edges` (u, v): label is the smallest id of its component. Loops and repeated edges are
    allowed; nodes without an edge to another are left out."""
    e = cut(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        settled, nodes = _state(e)
        if settled:
            break
        e = _star(_star(e, True, nodes), False, nodes)
    roots = e.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("label"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(roots)
