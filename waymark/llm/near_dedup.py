"""Near-duplicate documents by HyperMinHash sketches, banding, and exact verification of shingle sets.

A document's set is that of its hashed word n-grams (64 bits). Each of `BANDS` independent hashes deals the shingles to `ROWS`
buckets; a bucket keeps its smallest hash as a register of leading-zero count and mantissa bits. The registers of one band,
hashed together, are its key: documents with an equal key in some band are candidates (at similarity 0.8 a pair is missed with
probability 5e-6). Candidates pass if the Jaccard estimate from all registers, corrected for registers that agree by chance,
is at least `GATE`, five standard errors below the threshold; then the full sets decide.

Equal sets are one node, and nodes that share a band key are paired as `banding` says: with one partner a round, then across the
components left. In a band of many nodes, as a template with a different filling in each document makes, those are compared block
by block with matrix products, and no pair becomes a row. Nothing is dropped: nodes of one component need no further link.

Defined results: null and empty texts and texts without words have an empty set, no link, and are kept; a document shorter than
a shingle has its whole word sequence as the only one; rows that repeat a doc_id share its component and are kept together;
rows with a null doc_id count as kept unless their set is linked to a document with an id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.banding import band_members, dealt, linked
from waymark.llm.registry import query
from waymark.llm.textbytes import batched, mix, salts, slices, word_hashes, words
from waymark.session import cut

BANDS, ROWS = 40, 6
MANTISSA = 10
GATE = 0.65
_STEP = np.uint64(0x9FB21C651E98DF25)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted within it, and their number."""
    start, _, count = words(data, offsets)
    rows = len(count)
    h = word_hashes(data, start)
    first = np.cumsum(count) - count
    found, owner = [], []
    for n in range(1, size + 1):
        # Rows with fewer words than `size` have one shingle of all their words; the others one at each of their places.
        if n < size:
            own = np.flatnonzero(count == n)
            at = first[own]
        else:
            places = np.maximum(count - size + 1, 0)
            own = np.repeat(np.arange(rows), places)
            at = np.arange(len(own)) - np.repeat(np.cumsum(places) - places, places) + np.repeat(first, places)
        if len(at):
            s = np.full(len(at), n, np.uint64)
            for j in range(n):
                s = s * _STEP + h[at + j]
            found.append(mix(s))
            owner.append(own)
    if not found:
        return np.zeros(0, np.uint64), np.zeros(rows, np.int64)
    s, d = np.concatenate(found), np.concatenate(owner)
    order = np.lexsort((s, d))
    s, d = s[order], d[order]
    fresh = np.ones(len(s), bool)
    fresh[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
    return s[fresh], np.bincount(d[fresh], minlength=rows)


def registers(s: np.ndarray, count: np.ndarray) -> np.ndarray:
    """(row, band, bucket) registers as uint16, 0 where a bucket is empty."""
    rows = len(count)
    owner = np.repeat(np.arange(rows), count) * ROWS
    out = np.empty((rows, BANDS, ROWS), np.uint16)
    for band, salt in enumerate(salts(BANDS, 2)):
        x = (s ^ salt) * _STEP
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        bucket = ((x >> np.uint64(32)) * np.uint64(ROWS)) >> np.uint64(32)
        least = np.full(rows * ROWS, 0xFFFFFFFF, np.uint32)
        np.minimum.at(least, owner + bucket.astype(np.int64), x.astype(np.uint32))
        # Leading zeros and the bits after the first one, as the exponent and mantissa of the value.
        fraction, exponent = np.frexp(least.astype(np.float64) + 1)
        cell = (33 - exponent) * (1 << MANTISSA) + ((fraction - 0.5) * (2 << MANTISSA)).astype(np.int64) + 1
        cell[least == 0xFFFFFFFF] = 0
        out[:, band] = cell.reshape(rows, ROWS)
    return out


def band_keys(cells: np.ndarray) -> np.ndarray:
    key = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None], len(cells), 0)
    for j in range(ROWS):
        key = (key ^ cells[:, :, j]) * _STEP
        key ^= key >> np.uint64(29)
    return mix(key)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of registers: agreeing cells among those filled in either, less chance agreement."""
    filled = ((a > 0) | (b > 0)).sum(1)
    agree = ((a == b) & (a > 0)).sum(1)
    chance = 2.0**-MANTISSA / 3
    return (agree / np.maximum(filled, 1) - chance) / (1 - chance)


def _lists(values: np.ndarray, count: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)), pa.int32()), pa.array(values.view(np.int64)))


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, fp, keys, cells) of rows (doc_id, text); fp is a hash of the whole set."""
    batched(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, data, offsets in slices(b.column(1)):
                s, count = shingles(data, offsets, size)
                cells = registers(s, count)
                total = np.append(np.uint64(0), np.cumsum(mix(s ^ np.uint64(77))))
                ends = np.cumsum(count)
                fp = mix(total[ends] - total[ends - count] + count.astype(np.uint64) * _STEP)
                keys = band_keys(cells)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(row, len(count)), pa.array(count), pa.array(fp.view(np.int64)),
                    _lists(keys.ravel(), np.full(len(count), BANDS)), pa.array([c.tobytes() for c in cells], pa.binary())],
                    ["doc_id", "n_shingles", "fp", "keys", "cells"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_shingles long, fp long, keys array<long>, cells binary")


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """(fp, members) of rows (doc_id, text): the full sets."""
    batched(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, data, offsets in slices(b.column(0)):
                s, count = shingles(data, offsets, size)
                total = np.append(np.uint64(0), np.cumsum(mix(s ^ np.uint64(77))))
                ends = np.cumsum(count)
                fp = mix(total[ends] - total[ends - count] + count.astype(np.uint64) * _STEP)
                yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), _lists(s, count)], ["fp", "members"])

    return docs.select("text").mapInArrow(run, "fp long, members array<long>")


def _likely(pairs: DataFrame, nodes: DataFrame, gate: float) -> DataFrame:
    """Pairs (a, b) whose sizes and registers allow the threshold."""
    side = nodes.select(F.col("fp"), F.col("n_shingles").alias("n"), "cells")
    both = pairs.join(side.select(F.col("fp").alias("a"), F.col("n").alias("na"), F.col("cells").alias("ca")), "a").join(
        side.select(F.col("fp").alias("b"), F.col("n").alias("nb"), F.col("cells").alias("cb")), "b")
    fair = both.filter(F.least("na", "nb") >= gate * F.greatest("na", "nb")).select("a", "b", "ca", "cb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint16).reshape(b.num_rows, -1) for i in (2, 3))
            keep = pa.array(estimate(x, y) >= gate)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["a", "b"])

    return fair.mapInArrow(run, "a long, b long")


def _sets_of(members: DataFrame, nodes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(node, members): the full sets of the nodes in `members`."""
    wanted = cut(members.select("node").distinct())
    ids = cut(nodes.join(wanted, F.col("fp") == F.col("node")).select("doc_id").distinct())
    # Texts go once through a shuffle by doc_id; the sets are made after it, for the wanted documents alone.
    texts = docs.select("doc_id", "text").join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
    return cut(shingle_sets(texts, size).withColumnRenamed("fp", "node").join(wanted, "node", "left_semi").dropDuplicates(["node"]))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes with 100 * intersection >= percent * union of their full sets."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("members").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.filter(100 * shared >= percent * (F.size("x") + F.size("y") - shared)).select("a", "b")


def crowd_links(node: np.ndarray, label: np.ndarray, sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect all nodes which pairs of similar sets under different labels connect, one per node at most."""
    n = len(node)
    size = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), size)
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    # Members of one set alone cannot be shared.
    held = times[column] > 1
    number = np.cumsum(times > 1) - 1
    column, owner = number[column[held]], owner[held]
    inter = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    width = 4096
    for at in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        low, high = np.searchsorted(column, [at, at + width])
        x = np.zeros((n, width), np.float32)
        x[owner[low:high], column[low:high] - at] = 1
        inter += x @ x.T
    close = 100 * inter >= percent * (size[:, None] + size[None] - inter)
    close &= label[:, None] != label[None]
    reach = np.arange(n)
    while True:
        new = np.minimum(reach, np.where(close, reach[None], n).min(1))
        new = new[new]
        if (new == reach).all():
            break
        reach = new
    moved = np.flatnonzero(reach != np.arange(n))
    return node[moved], node[reach[moved]]


def _crowds(crowded: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, block: int = 400, members: int = 200_000) -> DataFrame:
    """(a, b) edges within large bands (key, node, label, n): a band is dealt to blocks of about `block` nodes, or fewer where
    their sets would hold more than `members` shingles, and every pair of blocks that may hold different labels is compared in one task by
    products of incidence matrices."""
    sized = crowded.join(nodes.select(F.col("fp").alias("node"), F.col("n_shingles").alias("size")), "node")
    parts = dealt(sized, block, members).join(sets, "node")

    def compare(t: pa.Table) -> pa.Table:
        column = t.column("members").combine_chunks()
        ends = column.offsets.to_numpy()
        flat = column.values.to_numpy()
        a, b = crowd_links(t.column("node").to_numpy(), t.column("label").to_numpy(), [flat[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)], percent)
        return pa.table({"a": a, "b": b})

    return parts.groupBy("key", "part").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row (doc_id, text) of `docs`: documents are linked whose sets of `size`-word
    shingles are similar by `percent`; a component is named by its smallest doc_id, which is the one kept."""
    gate = GATE * percent / 80
    sketched = cut(sketches(docs, size))
    nodes = cut(sketched.filter("n_shingles > 0").groupBy("fp").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"), F.first("cells").alias("cells")))
    members = band_members(nodes.select(F.explode("keys").alias("key"), F.col("fp").alias("node")))

    sets = _sets_of(members, nodes, docs, size)

    def verify(pairs: DataFrame) -> DataFrame:
        return _verified(_likely(pairs, nodes, gate), sets, percent)

    labels = linked(members, verify, lambda crowded: _crowds(crowded, nodes, sets, percent))
    named = cut(nodes.select("fp", "doc_id").join(labels, F.col("fp") == F.col("id")).select("fp", "doc_id", "label"))
    lowest = cut(named.groupBy("label").agg(F.min("doc_id").alias("low")))
    told = cut(named.join(lowest, "label").select("fp", "low").unionByName(
        nodes.join(labels, F.col("fp") == F.col("id"), "left_anti").select("fp", F.col("doc_id").alias("low"))))
    out = sketched.select("doc_id", "n_shingles", "fp").join(told.withColumnRenamed("fp", "node"), F.col("fp") == F.col("node"), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("low")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id").eqNullSafe(component), F.lit(True)).alias("kept"))


#: All pairs that share a shingle, and the closure of their links.
ORACLE = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM split),
each AS (SELECT doc_id, unnest(s) AS x FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM each a JOIN each b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b WHERE 100 * n >= 80 * (len(p.s) + len(q.s) - n)),
ends AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, e.b FROM reach r JOIN ends e ON e.a = r.other)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) c USING (doc_id)"""


@query("op2_near_dedup", ORACLE)
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, size=4)
