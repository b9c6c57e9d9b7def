"""Near-duplicate embeddings through a robust-pruned flat graph, built in overlapping shards.

1. Equal vectors are one node with a count. Nodes meet in groups of bounded size around centroids; there a greedy pass gathers
   cells: nodes within half the threshold angle of a leader. Any two nodes of a cell are within the whole angle, so a large
   group of near copies becomes a few cells whose links are counted, not paired.
2. Leaders go to the shards of their `overlap` nearest centroids. A shard links each leader to a robustly pruned choice of its
   nearest (a neighbour is left out if one already chosen is nearer to it by `ALPHA`) and back. Each leader is searched for in
   the shard's graph: a beam search from the medoid and from its own place, then a range expansion over all found leaders whose
   cells may hold a link. A shard of more than `SHARD` leaders is dealt to blocks, and each pair of blocks is a shard.
3. Adjacency lists of all shards are united, and ranges are expanded over the united graph by joins until nothing new is found.
4. Cell pairs in range are decided in double precision: for a node and a cell by the angle to its leader where that suffices for
   all members, else member by member.
5. Recall is audited: `AUDIT` nodes with the smallest hash are compared with all nodes by brute force, in blocks. Below `RECALL`
   the search is repeated with twice the overlap.

Centroids come from k-means on a bounded sample (`SAMPLE` nodes with the smallest hash, at most `CENTROIDS` centroids); all rows
are indexed and searched.

Defined results: vectors that are null, empty, zero, hold null or non-finite components, or have another length than most, link with
nothing, as do rows with a null vec_id (whose component is null); all of these are kept. Rows that repeat count each as a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.components import components
from waymark.llm.registry import query
from waymark.llm.textbytes import batched
from waymark.session import cut

SAMPLE, CENTROIDS, PER_CENTROID = 20_000, 4096, 600
GROUP, SHARD = 1500, 1500
NEAREST, DEGREE, ALPHA, BEAM = 48, 20, 1.2, 24
AUDIT, RECALL = 256, 0.9
#: Kept from the bounds that angles prove, for rounding.
SLACK = 1e-6


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _bytes(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def angle(cos: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cos, -1, 1))


def unit_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, size, unit) of rows (vec_id, embedding): unit is null where the vector links with nothing."""
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(1)
            flat = column.flatten()
            count = np.array([0 if s is None else s for s in column.value_lengths().to_pylist()], np.int64)
            value = flat.to_numpy(zero_copy_only=False).astype(np.float64) if len(flat) else np.zeros(0)
            ends = np.cumsum(count)
            owner = np.repeat(np.arange(len(count)), count)
            bad = np.bincount(owner[~np.isfinite(value)], minlength=len(count)) > 0
            value = np.where(np.isfinite(value), value, 0.0)
            top = np.zeros(len(count))
            np.maximum.at(top, owner, np.abs(value))
            scaled = value / np.where(top > 0, top, 1.0)[owner]
            norm = np.sqrt(np.bincount(owner, scaled * scaled, len(count)))
            ok = (norm > 0) & ~bad
            unit = scaled / np.where(norm > 0, norm, 1.0)[owner] + 0.0
            out = [unit[z - c:z].tobytes() if good else None for z, c, good in zip(ends, count, ok, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(count), pa.array(out, pa.binary())], ["vec_id", "size", "unit"])

    return rows.select("vec_id", "embedding").mapInArrow(run, f"vec_id {kind}, size long, unit binary")


def kmeans(x: np.ndarray, k: int, turns: int = 4) -> np.ndarray:
    """Unit centroids of unit vectors; empty clusters keep their old centroid."""
    step = max(1, len(x) // k)
    c = x[::step][:k].copy()
    for _ in range(turns):
        own = np.concatenate([(x[a:a + 2048] @ c.T).argmax(1) for a in range(0, len(x), 2048)])
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), c)
    return c


def gather_cells(x: np.ndarray, near: float) -> tuple[np.ndarray, np.ndarray]:
    """Leader of each row and the cosine to it: in order, a row without a leader becomes one and takes all leaderless rows whose
    cosine is at least `near`."""
    leader = np.full(len(x), -1)
    cos = np.ones(len(x))
    sim = x @ x.T
    alone = (sim >= near).sum(1) <= 1
    leader[alone] = np.flatnonzero(alone)
    for i in np.flatnonzero(~alone):
        if leader[i] < 0:
            mine = np.flatnonzero((leader < 0) & (sim[i] >= near))
            leader[mine], cos[mine] = i, sim[i, mine]
            leader[i], cos[i] = i, 1.0
    return leader, cos


def robust_graph(sim: np.ndarray) -> np.ndarray:
    """Adjacency (boolean matrix): each node's robustly pruned nearest, made mutual."""
    n = len(sim)
    adjacent = np.zeros((n, n), bool)
    if n < 2:
        return adjacent
    reach = min(NEAREST, n - 1)
    masked = sim.copy()
    np.fill_diagonal(masked, -2)
    cand = np.argpartition(-masked, reach - 1, axis=1)[:, :reach]
    order = np.argsort(-np.take_along_axis(masked, cand, 1), axis=1, kind="stable")
    cand = np.take_along_axis(cand, order, 1)
    far = 1 - np.take_along_axis(sim, cand, 1)
    alive = np.ones(cand.shape, bool)
    rows = np.arange(n)
    for _ in range(min(DEGREE, reach)):
        open_rows = alive.any(1)
        if not open_rows.any():
            break
        first = alive.argmax(1)
        chosen = cand[rows, first]
        adjacent[rows[open_rows], chosen[open_rows]] = True
        alive[rows, first] = False
        alive &= ~(ALPHA * (1 - sim[chosen[:, None], cand]) <= far)
    return adjacent | adjacent.T


def search_shard(x: np.ndarray, radius: np.ndarray, theta: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges of the shard's graph and the pairs found in range, as index pairs."""
    sim = x @ x.T
    n = len(x)
    graph = robust_graph(sim)
    in_range = sim >= np.cos(np.minimum(theta + radius[:, None] + radius[None] + SLACK, np.pi))
    medoid = int((x @ x.mean(0)).argmax())
    rows = np.arange(n)
    seen = np.zeros((n, n), bool)
    seen[rows, rows] = True
    seen[:, medoid] = True
    done = np.zeros((n, n), bool)
    near = [np.flatnonzero(g) for g in graph]
    width = max((len(g) for g in near), default=0)
    table = np.full((n, max(width, 1)), -1)
    for i, g in enumerate(near):
        table[i, :len(g)] = g
    # Beam search of all rows in step: each expands its best seen, not yet expanded node until its beam is expanded.
    beam = np.full((n, BEAM), -1)
    beam[:, 0], beam[:, 1] = medoid, np.where(rows == medoid, -1, rows)
    active = rows
    for _ in range(4 * BEAM):
        b = beam[active]
        score = np.where(b >= 0, sim[active[:, None], b], -3)
        score[(b >= 0) & done[active[:, None], b]] = -3
        best = score.argmax(1)
        go = score[np.arange(len(active)), best] > -3
        active = active[go]
        if not len(active):
            break
        node = b[go, best[go]]
        done[active, node] = True
        new = table[node]
        fresh = (new >= 0) & ~seen[active[:, None], new]
        new = np.where(fresh, new, -1)
        r, c = np.nonzero(fresh)
        seen[active[r], new[r, c]] = True
        pool = np.concatenate([beam[active], new], 1)
        rank = np.where(pool >= 0, sim[active[:, None], pool], -3)
        keep = np.argpartition(-rank, BEAM - 1, axis=1)[:, :BEAM]
        beam[active] = np.take_along_axis(pool, keep, 1)
    # Range expansion: whatever is seen in range shows its neighbours.
    front = seen & in_range
    grown = np.zeros_like(front)
    step = graph.astype(np.float32)
    while True:
        new = front & ~grown
        live = new.any(1)
        if not live.any():
            break
        grown |= new
        seen[live] |= (new[live].astype(np.float32) @ step) > 0
        front = seen & in_range
    front |= front.T
    return np.argwhere(np.triu(graph, 1)), np.argwhere(np.triu(front, 1))


def _dealt(rows: DataFrame, key: str, most: int, whole: bool) -> DataFrame:
    """`rows` with `part`: keys of more than `most` rows are dealt to blocks by hash; with `whole`, to all pairs of blocks that hold the
    row's block. The number of keys is bounded by the number of centroids."""
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    blocks = F.ceil(F.col("_n") * (2 if whole else 1) / most).cast("int")
    blocks = F.when(F.col("_n") <= most, 1).otherwise(blocks)
    dealt = rows.join(F.broadcast(sizes), key).withColumn("_b", blocks).withColumn("_own", F.pmod(F.xxhash64("node", F.lit(3)), F.col("_b")).cast("int"))
    if whole:
        others = F.transform(F.sequence(F.lit(0), F.col("_b") - 1), lambda o: F.least(o, F.col("_own")) * F.col("_b") + F.greatest(o, F.col("_own")))
        return dealt.withColumn("part", F.explode(others)).drop("_n", "_b", "_own")
    return dealt.withColumnRenamed("_own", "part").drop("_n", "_b")


def _nearest_centroids(rows: DataFrame, shared, overlap: int) -> DataFrame:
    """`rows` (with unit) and homes: the numbers of the nearest centroids."""
    batched(rows.sparkSession)
    at, names = rows.columns.index("unit"), [*rows.columns, "homes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        take = min(overlap, len(c))
        for b in batches:
            if b.num_rows:
                sim = _matrix(b.column(at)) @ c.T
                best = np.argsort(-sim, axis=1, kind="stable")[:, :take]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(best.astype(np.int32).tolist(), pa.list_(pa.int32()))], names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{kinds}, homes array<int>")


def _cosine(rows: DataFrame, left: str, right: str) -> DataFrame:
    """`rows` without the binary columns `left`, `right`, and with cos, in double precision."""
    kept = [c for c in rows.columns if c not in (left, right)]
    ordered = rows.select(*kept, left, right)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema.fields[:-2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cos = (_matrix(b.column(len(kept))) * _matrix(b.column(len(kept) + 1))).sum(1)
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(cos)], [*kept, "cos"])

    return ordered.mapInArrow(run, f"{kinds}, cos double")


def _search(leaders: DataFrame, shared, theta: float, overlap: int) -> DataFrame:
    """(a, b) pairs of leaders, in both orders, whose cells may hold a link."""
    spread = _nearest_centroids(leaders.select("node", "unit", "radius"), shared, overlap).withColumn("home", F.explode("homes")).drop("homes")

    def search(t: pa.Table) -> pa.Table:
        node = t.column("node").to_numpy()
        edges, pairs = search_shard(_matrix(t.column("unit")), t.column("radius").to_numpy(), theta)
        both = np.concatenate([edges, pairs])
        return pa.table({"a": node[both[:, 0]], "b": node[both[:, 1]], "found": np.repeat([False, True], [len(edges), len(pairs)])})

    raw = cut(_dealt(cut(spread), "home", SHARD, True).groupBy("home", "part").applyInArrow(search, "a long, b long, found boolean"))
    both = raw.unionByName(raw.select(F.col("b").alias("a"), F.col("a").alias("b"), "found"))
    graph = cut(both.filter("not found").select("a", "b").distinct())
    known = new = cut(both.filter("found").select("a", "b").distinct())
    side = leaders.select("node", "unit", "radius")
    while not new.isEmpty():
        # Neighbours, in the united graph, of what was found.
        wider = new.join(graph.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select("a", F.col("c").alias("b")).filter("a <> b").distinct()
        wider = wider.join(known, ["a", "b"], "left_anti")
        told = wider.join(side.select(F.col("node").alias("a"), F.col("unit").alias("x"), F.col("radius").alias("ra")), "a").join(
            side.select(F.col("node").alias("b"), F.col("unit").alias("y"), F.col("radius").alias("rb")), "b")
        hit = _cosine(told, "x", "y").filter(F.col("cos") >= F.cos(F.least(F.lit(theta + SLACK) + F.col("ra") + F.col("rb"), F.lit(math.pi))))
        new = cut(hit.select("a", "b").unionByName(hit.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
        known = cut(known.unionByName(new).distinct())
    return known


def _decided(cells: DataFrame, leaders: DataFrame, pairs: DataFrame, theta: float, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(node, n) links of each node outside its cell, and (u, v) cells that hold a link."""
    mine = pairs.join(cells.select(F.col("leader").alias("a"), "node", "unit"), "a")
    facing = mine.join(leaders.select(F.col("node").alias("b"), F.col("unit").alias("of"), "radius", "weight"), "b")
    seen = cut(_cosine(facing.select("a", "b", "node", "radius", "weight", "unit", "of"), "unit", "of").withColumn("apart", F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), "cos")))))
    whole = F.col("apart") + F.col("radius") <= theta - SLACK
    all_of = seen.filter(whole).select("a", "b", "node", F.col("weight").alias("n"))
    open_rows = seen.filter(~whole & (F.col("apart") - F.col("radius") <= theta + SLACK)).select("a", "b", "node")
    each = open_rows.join(cells.select("node", "unit"), "node").join(cells.select(F.col("leader").alias("b"), F.col("unit").alias("other"), "n"), "b")
    some = _cosine(each.select("a", "b", "node", "n", "unit", "other"), "unit", "other").filter(F.col("cos") >= threshold).select("a", "b", "node", "n")
    links = cut(all_of.unionByName(some))
    return links.groupBy("node").agg(F.sum("n").alias("n")), links.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()


def audit_recall(nodes: DataFrame, degrees: DataFrame, threshold: float, sample: int = AUDIT) -> float:
    """Share of the links of `sample` nodes, counted against all nodes by brute force, that `degrees` (node, links) has."""
    asked = nodes.orderBy(F.xxhash64("node", F.lit(9))).limit(sample).select("node", "unit").toArrow()
    ids, x = asked.column(0).to_numpy(), _matrix(asked.column(1).combine_chunks())
    shared = nodes.sparkSession.sparkContext.broadcast((ids, x))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, x = shared.value
        total = np.zeros(len(ids), np.int64)
        for b in batches:
            if b.num_rows:
                total += ((x @ _matrix(b.column(0)).T) >= threshold) @ b.column(1).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], ["node", "n"])

    true = nodes.select("unit", "n").mapInArrow(run, "node long, n long").groupBy("node").agg((F.sum("n") - 1).alias("true"))
    got = true.join(degrees, "node").agg(F.sum("true").alias("all"), F.sum(F.least("true", "links")).alias("found")).first()
    return got["found"] / got["all"] if got["all"] else 1.0


def near_vectors(rows: DataFrame, threshold: float = 0.95, overlap: int = 2) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row (vec_id, embedding)."""
    spark = rows.sparkSession
    batched(spark)
    theta = math.acos(threshold)
    vectors = cut(unit_vectors(rows))
    usual = vectors.filter("unit is not null and vec_id is not null").groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    size = usual["size"] if usual else -1
    valid = F.col("unit").isNotNull() & F.col("vec_id").isNotNull() & (F.col("size") == size)
    nodes = cut(vectors.filter(valid).groupBy("unit").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("n")).withColumn("node", F.xxhash64("unit")))
    n = nodes.count()
    if not n:
        alone = F.col("vec_id").alias("component_id")
        return vectors.select("vec_id", F.lit(0).cast("long").alias("n_links"), alone, F.lit(True).alias("kept"))
    sample = _matrix(nodes.orderBy(F.xxhash64("node", F.lit(4))).limit(SAMPLE).select("unit").toArrow().column(0).combine_chunks())
    shared = spark.sparkContext.broadcast(kmeans(sample, max(1, min(CENTROIDS, len(sample), -(-n // PER_CENTROID)))))

    near = math.cos(theta / 2 - SLACK)
    homed = cut(_nearest_centroids(nodes, shared, 1).withColumn("home", F.element_at("homes", 1)).drop("homes"))

    def cell(t: pa.Table) -> pa.Table:
        leader, cos = gather_cells(_matrix(t.column("unit").combine_chunks()), near)
        return pa.table({"node": t.column("node"), "unit": t.column("unit"), "low": t.column("low"), "n": t.column("n"),
                         "leader": t.column("node").to_numpy()[leader], "cos": cos})

    low_kind = nodes.schema["low"].dataType.simpleString()
    cells = cut(_dealt(homed, "home", GROUP, False).groupBy("home", "part").applyInArrow(
        cell, f"node long, unit binary, low {low_kind}, n long, leader long, cos double"))
    sums = cut(cells.groupBy("leader").agg(F.sum("n").alias("weight"), F.min("cos").alias("least")))
    leaders = cut(cells.filter("node = leader").select("node", "unit").join(sums, F.col("node") == F.col("leader")).select(
        "node", "unit", "weight", F.when(F.col("least") < 1, F.acos(F.greatest(F.lit(-1.0), "least"))).otherwise(0.0).alias("radius")))

    while True:
        pairs = _search(leaders, shared, theta, overlap)
        outside, touching = _decided(cells, leaders, pairs, theta, threshold)
        outside = cut(outside)
        inside = cells.select("node", "leader", "low", "n").join(sums.select("leader", "weight"), "leader")
        degrees = cut(inside.join(outside.withColumnRenamed("n", "more"), "node", "left").select(
            "node", "leader", "low", (F.col("weight") - 1 + F.coalesce("more", F.lit(0))).alias("links")))
        if audit_recall(nodes, degrees, threshold) >= RECALL or overlap >= len(shared.value):
            break
        overlap *= 2

    labels = cut(components(touching))
    placed = cut(degrees.join(labels, F.col("leader") == F.col("id"), "left").withColumn("label", F.coalesce("label", "leader")))
    lowest = cut(placed.groupBy("label").agg(F.min("low").alias("component")))
    told = cut(placed.join(lowest, "label").select("node", "links", "component"))
    out = vectors.withColumn("own", F.when(valid, F.xxhash64("unit"))).select("vec_id", "own").join(told, F.col("own") == F.col("node"), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


ORACLE = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
ends AS (SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(vec_id, other) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, x.b FROM reach r JOIN ends x ON x.a = r.other)
SELECT v.vec_id, coalesce(n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM embeddings v JOIN (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY 1) USING (vec_id)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM ends GROUP BY 1) USING (vec_id)"""


@query("op10_embedding_graph", ORACLE)
def op10_embedding_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
