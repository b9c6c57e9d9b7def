"""Toxicity by averaged subword embeddings and a linear softmax, both trained here in numpy.

A word is the bag of its character (byte) n-grams, bounded by markers; n-grams are hashed to `BUCKETS` rows of an embedding
table. A text is the mean of the embeddings of its n-grams, where a word counts `REPEATS` times at most, so that one repeated without end does
not stand for the text; the softmax layer on top is trained together with the
table by gradient descent with steps scaled per parameter (Adagrad). Misspelt or unseen words share most n-grams with known ones and so land near them.

As the layer is linear, the margin of a text is the mean over these n-grams of one number per bucket; scoring gathers the
numbers for whole texts.

Training rows are a bounded sample: all labelled rows of the training folds if there are at most `sample`, else those with
the smallest hash of their id, of each class at most `sample / 2`.

Defined results: null or empty texts have no n-gram and get the score of the bias alone; rows that repeat are scored alike;
without any training row of both classes every score is the share of class 1 (0.0 without rows).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.registry import query
from waymark.llm.textbytes import LOWER, SLICE_BYTES, batched, fold, mix, slices, widened, word_hashes, words

BUCKETS = 1 << 17
WIDTH = 8
GRAMS = (3, 4, 5)
REPEATS = 3
#: Texts of at least this score are marked.
TOXIC = 0.3


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of every word with its markers, and the number of n-grams of each row; of equal words of a row the first
    `REPEATS` count."""
    start, end, count = words(data, offsets)
    if not len(start):
        return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
    owner = np.repeat(np.arange(len(count)), count)
    told = word_hashes(data, start)
    order = np.lexsort((told, owner))
    fresh = np.ones(len(order), bool)
    fresh[REPEATS:] = (told[order][REPEATS:] != told[order][:-REPEATS]) | (owner[order][REPEATS:] != owner[order][:-REPEATS])
    kept = np.sort(order[fresh])
    start, end, count = start[kept], end[kept], np.bincount(owner[kept], minlength=len(count))
    size = end - start + 2
    total = np.cumsum(size)
    first = total - size
    source = np.arange(int(total[-1])) + np.repeat(start - first - 1, size)
    source[first] = 0
    source[total - 1] = 0
    text = LOWER[data[source]].astype(np.uint64)
    text[first] = 1
    text[total - 1] = 2
    left = np.repeat(total, size) - np.arange(len(text))
    bounds = np.append(0, total)[np.append(0, np.cumsum(count))]
    per = np.zeros(len(text), np.int64)
    keys, places = [], []
    rolled = text.copy()
    for n in range(2, max(GRAMS) + 1):
        rolled[:-n + 1] = rolled[:-n + 1] * np.uint64(257) + text[n - 1:]
        if n in GRAMS:
            at = np.flatnonzero(left >= n)
            keys.append(((mix(rolled[at] + np.uint64(n << 50)) >> np.uint64(20)) % np.uint64(BUCKETS)).astype(np.int32))
            places.append(at)
            per[at] += 1
    places = np.concatenate(places)
    order = np.argsort(places, kind="stable")
    edges = np.append(0, np.cumsum(per))[bounds]
    return np.concatenate(keys)[order], np.diff(edges)


def train(texts: pa.Array, labels: list[int], epochs: int = 6, rate: float = 2.0, seed: int = 7) -> tuple[np.ndarray, float]:
    """Margin per bucket and bias after joint training of embeddings and layer."""
    y = np.asarray(labels, np.float32)
    share = float(y.mean()) if len(y) else 0.0
    if not 0 < share < 1:
        return np.zeros(BUCKETS, np.float32), (-30.0 if share == 0 else 30.0)
    # Bags of all texts in a few flat arrays, which give their memory back.
    keys, weights, sizes = [], [], []
    for _, data, offsets in slices(texts, SLICE_BYTES // 8):  # the n-grams of a slice are many times its bytes, and the driver holds them
        key, count = grams(data, offsets)
        owner = np.repeat(np.arange(len(count)), count)
        told, times = np.unique(owner.astype(np.int64) * BUCKETS + key, return_counts=True)
        owner = told // BUCKETS
        keys.append((told % BUCKETS).astype(np.int32))
        weights.append((times / count[owner]).astype(np.float32))
        sizes.append(np.bincount(owner, minlength=len(count)))
    keys, weights, sizes = np.concatenate(keys), np.concatenate(weights), np.concatenate(sizes)
    first = np.cumsum(sizes) - sizes
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.05, (BUCKETS, WIDTH)).astype(np.float32)
    layer = rng.normal(0, 0.3, (WIDTH, 2)).astype(np.float32)
    bias = np.log(np.array([1 - share, share], np.float32))
    seen = np.full((BUCKETS, WIDTH), 1e-12, np.float32)
    seen_layer = np.full((WIDTH, 2), 1e-12, np.float32)
    batch = 32
    for epoch in range(epochs):
        order = rng.permutation(len(sizes))
        step = rate * (1 - epoch / epochs)
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            size = sizes[rows]
            at_each = np.repeat(first[rows], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            ids, w, owner = keys[at_each], weights[at_each], np.repeat(np.arange(len(rows)), size)
            parts = table[ids] * w[:, None]
            mean = np.stack([np.bincount(owner, parts[:, j], len(rows)) for j in range(WIDTH)], 1).astype(np.float32)
            z = mean @ layer + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows].astype(int)] -= 1
            grad = (p @ layer.T)[owner] * w[:, None]
            slope = mean.T @ p
            seen_layer += slope * slope
            layer -= 0.1 * step * slope / np.sqrt(seen_layer)
            used, back = np.unique(ids, return_inverse=True)
            pull = np.stack([np.bincount(back, grad[:, j], len(used)) for j in range(WIDTH)], 1).astype(np.float32)
            seen[used] += pull * pull
            table[used] -= step * pull / np.sqrt(seen[used])
    margin = (table @ (layer[:, 1] - layer[:, 0])).astype(np.float32)
    margin[(seen <= 1e-12).all(1)] = 0  # buckets that no training text has say nothing
    return margin, float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", sample: int = 6000) -> tuple[np.ndarray, float]:
    """Model from the rows of `docs` (doc_id, text) that `labels` (doc_id, toxic) marks; at most `sample` rows come to the driver.
    The layer's bias is reset to the classes' odds in all labelled rows."""
    known = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rank = F.xxhash64(F.col("doc_id"), F.lit(11))
    odds = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for label in (0, 1):
        part = known.filter(F.col("toxic") == label).orderBy(rank, "doc_id").limit(sample // 2)
        chosen = part if chosen is None else chosen.unionByName(part)
    got = docs.select("doc_id", F.col(text).alias("text")).join(chosen, "doc_id").toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    labels = got.column("toxic").to_pylist()
    texts = got.column("text").cast(pa.large_string()).combine_chunks() if len(got) else pa.array([], pa.large_string())
    margin, bias = train(texts, labels)
    ones = sum(labels)
    if 0 < ones < len(labels) and odds.get(0) and odds.get(1):
        bias += float(np.log(odds[1] / odds[0]) - np.log(ones / (len(labels) - ones)))
    return margin, bias


def scores(texts: pa.Array, margin: np.ndarray, bias: float) -> np.ndarray:
    out = np.empty(len(texts))
    for row, data, offsets in slices(texts, SLICE_BYTES // 2):
        keys, count = grams(data, offsets)
        total = np.append(0.0, np.cumsum(margin[keys], dtype=np.float64))
        ends = np.cumsum(count)
        z = (total[ends] - total[ends - count]) / np.maximum(count, 1) + bias
        out[row:row + len(count)] = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    return out


def score_toxicity(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", into: str = "score") -> DataFrame:
    """`docs` with the model's probability of class 1 for every whole text; an older column named `into` is replaced."""
    spark = docs.sparkSession
    batched(spark)
    shared = spark.sparkContext.broadcast(model)
    docs = docs.drop(into) if into in docs.columns else docs
    at = docs.columns.index(text)
    schema = widened(docs.schema, **{into: "double"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margin, bias = shared.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores(b.column(at), margin, bias))], [*b.schema.names, into])

    return docs.mapInArrow(run, schema)


def load_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = load_labels(spark, sf_dir).filter(fold("doc_id", 4) != 2)
    model = fit(docs, labels)
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))
