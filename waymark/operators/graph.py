"""Connected components and label votes on edge tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.session import cut


def components(nodes: DataFrame, edges: DataFrame, by=("bag_id",)) -> DataFrame:
    """Smallest node id of each node's component, as (by, id, label).

    `edges` lists (by, u, v) in both directions. Every round hooks roots onto smaller neighbouring
    labels and halves the paths, so the number of rounds grows with the logarithm of the longest path.
    All reductions are minima, combined before the shuffle; each round is written to the checkpoint
    folder.
    """
    edges = cut(edges.select(*by, "u", "v"))
    labels = cut(nodes.select(*by, "id").distinct().withColumn("label", F.col("id")))
    while True:
        parent = labels.select(*[F.col(c).alias(c) for c in by], F.col("id").alias("label"), F.col("label").alias("up"))
        grand = labels.join(parent, [*by, "label"])
        near = edges.join(grand.select(*by, F.col("id").alias("v"), "up"), [*by, "v"]).groupBy(*by, F.col("u").alias("id")).agg(
            F.min("up").alias("m"))
        hooked = labels.join(near, [*by, "id"])
        offers = [
            grand.select(*by, "id", "up", F.col("label").alias("old")),
            hooked.select(*by, "id", F.col("m").alias("up"), F.lit(None).cast("long").alias("old")),
            hooked.select(*by, F.col("label").alias("id"), F.col("m").alias("up"), F.lit(None).cast("long").alias("old")),
        ]
        step = reduce(DataFrame.unionByName, offers).groupBy(*by, "id").agg(F.min("up").alias("label"), F.max("old").alias("old"))
        step = cut(step)
        done = step.filter("label <> old").limit(1).count() == 0
        labels = step.drop("old")
        if done:
            return labels


def component_sizes(labels: DataFrame, by=("bag_id",)) -> DataFrame:
    return labels.groupBy(*by, "label").agg(F.count(F.lit(1)).alias("size"))


def smooth_labels(labels: DataFrame, adjacency: DataFrame, iterations: int, by=("bag_id",), key: str = "fid",
                  label: str = "kf_idx") -> DataFrame:
    """Majority vote over neighbours: the most frequent label (lowest on a tie) replaces a node's own if
    it has more than half of all its neighbours. `adjacency` lists (by, u, v) in both directions; unlabelled
    neighbours count towards the degree but cast no vote."""
    degree = adjacency.groupBy(*by, F.col("u").alias(key)).agg(F.count(F.lit(1)).alias("_deg"))
    current = labels.select(*by, key, label)
    for _ in range(iterations):
        votes = adjacency.join(current.select(*by, F.col(key).alias("v"), F.col(label).alias("_l")), [*by, "v"]).filter(
            F.col("_l").isNotNull())
        tally = votes.groupBy(*by, F.col("u").alias(key), "_l").agg(F.count(F.lit(1)).alias("_c"))
        best = tally.groupBy(*by, key).agg(F.max(F.struct("_c", (-F.col("_l")).alias("neg"))).alias("_w"))
        won = best.join(degree, [*by, key]).filter(F.col("_w._c") > F.col("_deg") / 2).select(
            *by, key, (-F.col("_w.neg")).alias("_new"))
        current = current.join(won, [*by, key], "left").select(*by, key, F.coalesce("_new", label).alias(label))
        current = cut(current)
    return current
