"""From band members to component labels without pairing all members of a band.

In every round each node is paired with one partner at most, the leader of most of its bands; verified pairs are contracted, and
bands whose nodes all lie in one component are done. The first leaders are the smallest nodes, later ones are drawn by hash.
After some rounds, or one without a link, nodes of one band that still lie in different components are compared: in bands
of up to `SPLIT` nodes as pairs, in larger ones by the `crowd` function given. Nodes of one component need no further pair, so
nothing is lost but what the keys themselves miss.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.llm.components import components
from waymark.session import cut, only

SPLIT = 16
ROUNDS = 2


def band_members(bands: DataFrame) -> DataFrame:
    """(key, node, low) of the (key, node) rows whose key several nodes share; low is the smallest of them."""
    shared = cut(bands.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low <> high").select("key", "low"))
    return cut(bands.join(shared, "key").distinct())


def _partners(led: DataFrame) -> DataFrame:
    """(a, b): each node with the leader of most of its bands, from (key, node, lead) rows."""
    return led.filter("node <> lead").groupBy("node", "lead").agg(F.count(F.lit(1)).alias("n")).groupBy("node").agg(
        F.max(F.struct("n", "lead")).alias("best")).select(F.col("node").alias("a"), F.col("best.lead").alias("b"))


def _labels(links: DataFrame) -> DataFrame:
    return only(lambda: components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))))


def _unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, label, n) of the bands that hold several components, n being their nodes."""
    return only(lambda: _mixed(members, labels))


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    placed = cut(members.select("key", "node").join(labels, F.col("node") == F.col("id"), "left").select("key", "node", F.coalesce("label", "node").alias("label")))
    mixed = cut(placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n")).filter("low <> high").select("key", "n"))
    return placed.join(mixed, "key")


def dealt(crowded: DataFrame, block: int, most: int) -> DataFrame:
    """(key, part, node, label): the nodes of each band (key, node, label, size) in blocks of about `block` nodes and `most` of size, a part
    for every pair of blocks that may hold different labels. A label beyond one block has blocks of its own, which are not paired with each
    other; all smaller labels of a band share theirs. A component that fills a band thus costs its blocks times those of the rest."""

    def blocks(n: str, size: str) -> Column:
        return F.greatest(F.ceil(F.col(n) / block), F.least(F.col(n), F.ceil(F.col(size) / most))).cast("int")

    held = crowded.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    held = cut(held.withColumn("of", F.when(blocks("n", "size") > 1, F.col("label"))))
    groups = held.groupBy("key", "of").agg(F.sum("n").alias("n"), F.sum("size").alias("size")).select(
        F.col("key").alias("band"), F.col("of").alias("group"), blocks("n", "size").alias("blocks"))
    before = Window.partitionBy("band").orderBy(F.col("group").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    ranges = groups.select("band", "group", "blocks", F.coalesce(F.sum("blocks").over(before), F.lit(0)).alias("start"),
                           F.sum("blocks").over(Window.partitionBy("band")).alias("total"))
    placed = cut(held.join(ranges, (F.col("key") == F.col("band")) & F.col("of").eqNullSafe(F.col("group"))).select(
        "key", "label", "of", "start", "blocks", "total"))
    own = crowded.select("key", "node", "label").join(placed, ["key", "label"]).withColumn(
        "own", F.col("start") + F.pmod(F.xxhash64("node", F.lit(6)), F.col("blocks")))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("total") - 1),
                      lambda o: F.col("of").isNull() | (o < F.col("start")) | (o >= F.col("start") + F.col("blocks")))
    parts = F.transform(others, lambda o: F.least(o, F.col("own")) * F.col("total") + F.greatest(o, F.col("own")))
    return own.select("key", F.explode(parts).alias("part"), "node", "label")


def linked(members: DataFrame, verify: Callable[[DataFrame], DataFrame], crowd: Callable[[DataFrame], DataFrame], split: int = SPLIT,
           rounds: int = ROUNDS) -> DataFrame:
    """(id, label) of all nodes that have a link; label is the smallest node of the component. `verify` returns those of the distinct
    pairs (a, b) given to it that are links; `crowd` returns (a, b) rows that connect what is linked within the large bands
    (key, node, label, n) given to it."""
    links = only(lambda: verify(cut(_partners(members.withColumnRenamed("low", "lead")))))
    labels = _labels(links)
    rest = _unsettled(members, labels)
    for turn in range(1, rounds):
        lead = cut(rest.groupBy("key").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("draw"), "node", "label")).alias("lead")).select(
            "key", F.col("lead.node").alias("lead"), F.col("lead.label").alias("of")))
        pairs = cut(_partners(rest.join(lead, "key").filter("label <> of")))
        if pairs.isEmpty():
            return labels
        more = only(lambda: verify(pairs))  # noqa: B023 - called at once
        if more.isEmpty():
            break
        links = links.unionByName(more)
        labels = _labels(links)
        rest = _unsettled(rest, labels)
    few = rest.filter(F.col("n") <= split)
    left, right = (few.select("key", F.col("node").alias(a), F.col("label").alias(f"l{a}")) for a in "ab")
    met = only(lambda: verify(cut(left.join(right, "key").filter("a < b and la <> lb").select("a", "b").distinct())))
    blocked = only(lambda: crowd(rest.filter(F.col("n") > split)))
    return _labels(links.unionByName(met).unionByName(blocked))
