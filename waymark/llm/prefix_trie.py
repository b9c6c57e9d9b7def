"""Prefix trie of conversations, rolled up by centroid decomposition of its parent edges.

Turns become hashes once; texts do not travel. Turns are ranked within their conversation by a range partitioning over (conversation, turn), so that a
conversation may hold any share of the rows. The node a conversation passes at a depth is named by the exclusive or of the hashes of
(place, role, text) up to there, 128 bits, which is a prefix sum and is taken in blocks of bounded length. A node's members, its smallest
member and its weight (turns of its members from it on, one each for the node itself: the sum of members over its subtree) are aggregated map-side.

Leaves and saved tokens are summed over subtrees by centroids. In every round each component of the forest, a connected part below
its top node, is split at its centroid: the nodes that hold more than half of the top's weight are one path, from the top to the centroid, whose children
hold at most half each. The total of what lies below the centroid in the component is aggregated and added to every node on that path; its weight is
taken off there; the part above and each child's part are the components of the next round. Weights halve, so rounds grow with the logarithm of
the rows however deep the trie is. Which child's part a node lies in is read off the conversation of its smallest member, one step
below the centroid. Components of up to `LOCAL` nodes are dealt to groups of bounded size and split to the end there, by the same rule in numpy.

Member ids are joined in blocks of at most `IDS` ids; a hash is fed block by block, in order, as a stream.

Defined results: rows without a conversation id belong to none; turns are ordered nulls first, equal ones by a hash of role and text, equal rows are
turns of their own; null role or text is empty; an empty table has no node; further columns are left aside.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.llm.registry import query
from waymark.llm.textbytes import WORD
from waymark.session import cut

#: Conversations that share their beginning, and the lengths a beginning may have.
FAMILY, HEADS = 20, 4
#: Places of a prefix sum, nodes of a component and ids of a text that one group handles.
BLOCK, LOCAL, IDS = 4096, 20_000, 4096


def _root() -> Column:
    """The key of the root: no turn, no bit set."""
    return F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))


def ranked_turns(conversations: DataFrame) -> DataFrame:
    """(part, conv_id, rank, total, a, b, n_words): turns as two hashes, with their rank in the conversation and its length."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = cut(conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), text, role).alias("b"),
        F.size(F.regexp_extract_all(text, F.lit(WORD), 0)).cast("long").alias("n_words")))
    order = [F.col("turn").asc_nulls_first(), "a", "b", "nth"]
    # Equal rows are told apart by their place in the table, so that ranges can divide them too.
    spread = turns.withColumn("nth", F.monotonically_increasing_id()).repartitionByRange("conv_id", *order)
    spread = cut(spread.withColumn("part", F.spark_partition_id()))
    pieces = spread.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    of = Window.partitionBy("conv_id")
    pieces = pieces.select("conv_id", "part", F.sum("n").over(of).alias("total"),
                           F.coalesce(F.sum("n").over(of.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    local = spread.withColumn("local", F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order)))
    return cut(local.join(pieces, ["part", "conv_id"]).select("part", "conv_id", (F.col("before") + F.col("local")).alias("rank"), "total", "a", "b", "n_words"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, depth, length, a, b, n_words), (conv_id, length)): conversations with the beginning of their family's first one."""
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = turns.filter("rank = 1").select("conv_id", "total", first.alias("first"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h"))
    begins = turns.filter((F.col("rank") < HEADS) & (F.col("conv_id") == first)).select(F.col("conv_id").alias("first"), "rank", F.col("total").alias("given"), "a", "b", "n_words")
    given = begins.filter("rank = 1").select("first", "given")
    convs = cut(convs.join(given, "first", "left").withColumn("taken", F.least("h", F.coalesce("given", F.lit(0)))).withColumn(
        "length", F.col("taken") + F.greatest(F.col("total") - F.col("h"), F.lit(0))))
    # What a conversation's turns need to know of it is dealt to its parts, which are bounded, and not to its rows at once.
    known = turns.select("part", "conv_id").distinct().join(convs.select("conv_id", "h", "taken", "length"), "conv_id")
    own = turns.join(known, ["part", "conv_id"]).filter("rank > h").select("conv_id", (F.col("taken") + F.col("rank") - F.col("h")).alias("depth"), "length", "a", "b", "n_words")
    heads = convs.select("conv_id", "first", "taken", "length").join(begins, "first").filter("rank <= taken").select("conv_id", F.col("rank").cast("long").alias("depth"), "length", "a", "b", "n_words")
    return own.unionByName(heads), convs.select("conv_id", "length")


def running_xor(rows: DataFrame, names: tuple[str, str], block: int = BLOCK) -> DataFrame:
    """`rows` (conv_id, place, …) with the columns in `names` replaced by their exclusive or up to and including the place."""
    rows = rows.withColumn("block", F.floor(F.col("place") / block))
    within = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumns({c: F.bit_xor(c).over(within) for c in names})
    if (rows.agg(F.max("block")).first()[0] or 0) < 1:
        return summed.drop("block")
    totals = cut(rows.groupBy("conv_id", F.col("block").alias("place")).agg(*[F.bit_xor(c).alias(c) for c in names]))
    upto = running_xor(totals, names, block)
    before = upto.select("conv_id", (F.col("place") + 1).alias("block"), *[F.col(c).alias(f"{c}_before") for c in names])
    joined = summed.join(before, ["conv_id", "block"], "left")
    return joined.withColumns({c: F.col(c).bitwiseXOR(F.coalesce(f"{c}_before", F.lit(0))) for c in names}).drop("block", *[f"{c}_before" for c in names])


def passages(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, depth, length, key, parent, n_words): the node each rebuilt conversation passes at each depth, and the node above."""
    at = turns.withColumns({"a": F.xxhash64("depth", "a", "b"), "b": F.xxhash64("b", "depth", "a"), "place": F.col("depth")})
    at = running_xor(at.withColumns({"own_a": F.col("a"), "own_b": F.col("b")}), ("a", "b"), block)
    above = F.struct(F.col("a").bitwiseXOR(F.col("own_a")).alias("a"), F.col("b").bitwiseXOR(F.col("own_b")).alias("b"))
    return at.select("conv_id", "depth", "length", F.struct("a", "b").alias("key"), above.alias("parent"), "n_words")


def trie(passed: DataFrame, lengths: DataFrame) -> DataFrame:
    """(key, parent, depth, conv_id, n_convs, weight, n_children, saved) of every node, the root included."""
    below = passed.groupBy("key").agg(
        F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"), F.min("n_words").alias("n_words"))
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("length") + 1).alias("weight")).filter("n_convs > 0").select(
        _root().alias("key"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("struct<a:long,b:long>").alias("parent"), "conv_id", "n_convs", "weight", F.lit(0).cast("long").alias("n_words"))
    nodes = cut(below.unionByName(root))
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    return nodes.join(children, "key", "left").select("key", "parent", "depth", "conv_id", "n_convs", "weight", F.coalesce("n_children", F.lit(0)).alias("n_children"),
                                                      ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved"))


def split_once(nodes: DataFrame, passed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes of the components left, centroids done): one round on nodes (key, conv_id, depth, comp, weight, leaf, saved, leaves, tokens)."""
    tops = nodes.groupBy("comp").agg(F.max("weight").alias("whole"))
    weighed = nodes.join(tops, "comp")
    heavy = 2 * F.col("weight") > F.col("whole")
    centres = cut(weighed.filter(heavy).groupBy("comp").agg(F.max(F.struct("depth", "key", "weight")).alias("c"), F.max("whole").alias("whole")).select(
        "comp", "whole", F.col("c.key").alias("centre"), F.col("c.depth").alias("level"), F.col("c.weight").alias("cut_off")))
    # Nodes of one conversation in one component are one piece of its path: it is looked up once, a step below the centroid.
    deep = nodes.groupBy("comp", "conv_id").agg(F.max("depth").alias("deepest")).join(centres, "comp").filter("deepest > level")
    step = passed.select("conv_id", F.col("depth").alias("at"), F.col("key").alias("child"), F.col("parent").alias("under"))
    under = deep.withColumn("at", F.col("level") + 1).join(step, ["conv_id", "at"]).filter("under = centre").select("comp", "conv_id", "child")
    placed = cut(nodes.join(centres, "comp").join(under, ["comp", "conv_id"], "left").withColumn(
        "to", F.when(F.col("depth") > F.col("level"), F.col("child"))).withColumn("done", F.col("key") == F.col("centre")).drop("child"))
    totals = placed.filter("done or to is not null").groupBy("comp").agg(F.sum("leaf").alias("more_leaves"), F.sum("saved").alias("more_tokens"))
    path = (2 * F.col("weight") > F.col("whole")) & F.col("to").isNull()
    out = cut(placed.join(totals, "comp").withColumns({
        "leaves": F.col("leaves") + F.when(path, F.col("more_leaves")).otherwise(0), "tokens": F.col("tokens") + F.when(path, F.col("more_tokens")).otherwise(0),
        "weight": F.col("weight") - F.when(path & ~F.col("done"), F.col("cut_off")).otherwise(0), "comp": F.coalesce("to", "comp")}))
    return out.filter("not done").select(nodes.columns), out.filter("done").select("key", "leaves", "tokens")


def _intervals(parent: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every node's subtree in a preorder of the forest `parent` (-1: a top)."""
    n = len(parent)
    levels = np.argsort(depth, kind="stable")
    bounds = np.append(np.flatnonzero(np.diff(depth[levels], prepend=depth[levels[0]] - 1)), n) if n else np.zeros(1, np.int64)
    size = np.ones(n, np.int64)
    for low, high in zip(bounds[-2::-1], bounds[:0:-1], strict=True):
        rows = levels[low:high][parent[levels[low:high]] >= 0]
        np.add.at(size, parent[rows], size[rows])
    begin = np.zeros(n, np.int64)
    tops = np.flatnonzero(parent < 0)
    begin[tops] = np.cumsum(size[tops]) - size[tops]
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        rows = levels[low:high][parent[levels[low:high]] >= 0]
        rows = rows[np.argsort(parent[rows], kind="stable")]
        if len(rows):
            before = np.cumsum(size[rows]) - size[rows]
            first = np.searchsorted(parent[rows], parent[rows])
            begin[rows] = begin[parent[rows]] + 1 + before - before[first]
    return begin, begin + size


def split_all(parent: np.ndarray, depth: np.ndarray, weight: np.ndarray, leaf: np.ndarray, saved: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Sums of `leaf` and `saved` over the subtrees of a forest, by centroids, and the rounds taken. `weight` is at least one more than the sum
    of the children's."""
    n = len(parent)
    begin, end = _intervals(parent, depth)
    weight, leaves, tokens = weight.copy(), np.zeros(n, np.int64), np.zeros(n, np.int64)
    top_at = np.sort(begin[parent < 0])
    top_of = np.empty(n, np.int64)
    by_begin = np.argsort(begin)
    top_of[:] = by_begin[top_at[np.searchsorted(top_at, begin, "right") - 1]] if n else 0
    comp, rows, rounds = top_of, np.arange(n), 0
    while len(rows):
        rounds += 1
        of = comp[rows]
        path = rows[2 * weight[rows] > weight[of]]
        # The deepest node of each path is its component's centroid.
        path = path[np.lexsort((depth[path], comp[path]))]
        last = np.append(comp[path][1:] != comp[path][:-1], True)
        centre = np.full(n, -1)
        centre[comp[path][last]] = path[last]
        c = centre[of]
        below = (begin[rows] >= begin[c]) & (begin[rows] < end[c])
        for values, out in ((leaf, leaves), (saved, tokens)):
            total = np.zeros(n, np.int64)
            np.add.at(total, of[below], values[rows[below]])
            out[path] += total[comp[path]]
        above = path[~last]
        weight[above] -= weight[centre[comp[above]]]
        # A node below its centroid goes on with the child whose interval holds it.
        inner = rows[below & (rows != c)]
        kids = inner[parent[inner] == centre[comp[inner]]]
        order = np.argsort(comp[kids] * n + begin[kids])
        names = (comp[kids] * n + begin[kids])[order]
        to = kids[order][np.searchsorted(names, comp[inner] * n + begin[inner], "right") - 1]
        rows = rows[rows != c]
        comp[inner] = to
    return leaves, tokens, rounds


def _finish(table: pa.Table) -> pa.Table:
    """Whole components of nodes, split to the end."""
    key = np.stack([table.column(f"k{s}").to_numpy() for s in "ab"], 1).copy().view("i8,i8").ravel()
    above = np.stack([table.column(f"p{s}").to_numpy() for s in "ab"], 1).copy().view("i8,i8").ravel()
    order = np.argsort(key)
    at = np.minimum(np.searchsorted(key[order], above), len(key) - 1)
    parent = np.where((key[order[at]] == above) & ~table.column("top").to_numpy(zero_copy_only=False), order[at], -1)
    leaves, tokens, _ = split_all(parent, *[table.column(c).to_numpy() for c in ("depth", "weight", "leaf", "saved")])
    return pa.table({"ka": table.column("ka"), "kb": table.column("kb"), "leaves": pa.array(leaves + table.column("leaves").to_numpy()),
                     "tokens": pa.array(tokens + table.column("tokens").to_numpy())})


def rollup(nodes: DataFrame, passed: DataFrame, local: int = LOCAL) -> DataFrame:
    """(key, leaves, tokens): childless nodes and saved tokens over every node's subtree, for nodes of `trie`."""
    parents = nodes.select("key", "parent")
    # Written first, so that the one component of the first round is a key like any other and not a constant to nest loops over.
    left = cut(nodes.select("key", "conv_id", "depth", _root().alias("comp"), "weight", (F.col("n_children") == 0).cast("long").alias("leaf"), "saved",
                            F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("tokens")))
    done: list[DataFrame] = []
    small: list[DataFrame] = []
    while True:
        sizes = cut(left.groupBy("comp").agg(F.count(F.lit(1)).alias("n")))
        large = sizes.filter(F.col("n") > local).select("comp")
        if large.isEmpty():
            small.append(left)
            break
        small.append(left.join(large, "comp", "left_anti"))
        left, ready = split_once(left.join(large, "comp", "left_semi"), passed)
        done.append(ready)
    rest = small[0]
    for more in small[1:]:
        rest = rest.unionByName(more)
    rest = cut(rest.join(parents, "key"))
    groups = max(1, -(-rest.count() // local))
    given = rest.select(F.pmod(F.xxhash64("comp"), F.lit(groups)).alias("g"), F.col("key.a").alias("ka"), F.col("key.b").alias("kb"), F.coalesce("parent.a", F.lit(0)).alias("pa"),
                        F.coalesce("parent.b", F.lit(0)).alias("pb"), (F.col("key") == F.col("comp")).alias("top"), "depth", "weight", "leaf", "saved", "leaves", "tokens")
    out = given.groupBy("g").applyInArrow(_finish, "ka long, kb long, leaves long, tokens long").select(
        F.struct(F.col("ka").alias("a"), F.col("kb").alias("b")).alias("key"), "leaves", "tokens")
    for ready in done:
        out = out.unionByName(ready)
    return cut(out)


def end_hashes(ends: DataFrame, ids: int = IDS) -> DataFrame:
    """(key, ends_sha256) of the conversations (conv_id, key) that end at a node: SHA-256 of their ids, ascending, with commas between."""
    blocks = ends.groupBy("key", F.floor(F.col("conv_id") / ids).alias("block")).agg(F.concat_ws(",", F.array_sort(F.collect_list("conv_id")).cast("array<string>")).alias("part"))
    ordered = blocks.repartition("key").sortWithinPartitions("key", "block").select(F.col("key.a").alias("a"), F.col("key.b").alias("b"), "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            told = []
            for a, b, part in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (a, b) != now:
                    if now is not None:
                        told.append((*now, state.hexdigest()))
                    now, state = (a, b), hashlib.sha256(part.encode())
                else:
                    state.update(b"," + part.encode())
            yield _told(told)
        yield _told([(*now, state.hexdigest())] if now is not None else [])

    hashed = ordered.mapInArrow(run, "a long, b long, ends_sha256 string")
    return hashed.select(F.struct("a", "b").alias("key"), "ends_sha256")


def _told(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)], ["a", "b", "ends_sha256"])


def prefix_trie(conversations: DataFrame, block: int = BLOCK, local: int = LOCAL, ids: int = IDS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), a row per node."""
    turns, lengths = rebuilt(ranked_turns(conversations))
    lengths = cut(lengths)
    passed = cut(passages(turns, block))
    nodes = cut(trie(passed, lengths))
    sums = rollup(nodes, passed, local)
    ends = passed.filter("depth = length").select("conv_id", "key").unionByName(lengths.filter("length = 0").select("conv_id", _root().alias("key")))
    hashes = end_hashes(ends, ids)
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nothing = hashlib.sha256().hexdigest()
    told = nodes.join(sums, "key").join(hashes, "key", "left").join(above, "parent", "left")
    return told.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("tokens").alias("saved_tokens"),
                       F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


ORACLE = r"""
WITH digits AS (
  SELECT conv_id, list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda v, x:
    list_reduce(range(8), lambda w, i: xor(w >> 1, (w & 1) * 3988292384), xor(v, x)), 4294967295) AS v
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
heads AS (SELECT conv_id, conv_id - conv_id % 20 AS base, xor(v, 4294967295) % 4 AS h FROM digits),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS r FROM conversations WHERE conv_id IS NOT NULL),
rows AS (
  SELECT h.conv_id, t.r AS place, t.role, t.text FROM heads h JOIN turns t ON t.conv_id = h.base AND t.r <= h.h
  UNION ALL SELECT h.conv_id, t.r + 10 AS place, t.role, t.text FROM heads h JOIN turns t ON t.conv_id = h.conv_id AND t.r > h.h),
deep AS (
  SELECT conv_id, row_number() OVER w AS depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
    list(role || chr(1) || text) OVER (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS path
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY place)),
lengths AS (SELECT h.conv_id, coalesce(max(d.depth), 0) AS length FROM heads h LEFT JOIN deep d USING (conv_id) GROUP BY 1),
passed AS (
  SELECT conv_id, depth, words, md5(CAST(path AS VARCHAR)) AS node FROM deep UNION ALL SELECT conv_id, 0, 0, '' FROM lengths),
nodes AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(words) AS saved FROM passed GROUP BY 1, 2),
edges AS (
  SELECT n.node, p.node AS parent FROM nodes n JOIN passed p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
kids AS (SELECT parent AS node, count(*) AS n FROM edges GROUP BY 1),
sums AS (
  SELECT p.node, sum(n.saved) AS saved, sum(CASE WHEN k.n IS NULL THEN 1 ELSE 0 END) AS leaves
  FROM nodes n JOIN passed p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN kids k ON k.node = n.node GROUP BY 1),
ends AS (
  SELECT p.node, sha256(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id)) AS h FROM passed p JOIN lengths l ON l.conv_id = p.conv_id AND l.length = p.depth GROUP BY 1)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs, CAST(coalesce(k.n, 0) AS BIGINT) AS n_children,
  CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.h, sha256('')) AS ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node LEFT JOIN edges g ON g.node = n.node LEFT JOIN nodes q ON q.node = g.parent
LEFT JOIN kids k ON k.node = n.node LEFT JOIN ends e ON e.node = n.node"""


@query("op13_prefix_trie", ORACLE)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
