"""Language by a bidirectional gated recurrent network over bytes, trained here in numpy by backpropagation through time.

The bytes of a text are cut into windows of `WINDOW`; a forward and a backward GRU run over every window from a zero state, a
softmax on both states labels every position, and the mean of all positions' probabilities is the document's. Windows are
stepped together, so a very long text costs what many short ones do.

Training windows are a bounded sample: of each language the `per_lang` training documents with the smallest hash of their id,
and of each at most `per_doc` windows at hashed offsets, within its first 65,536 characters.

Defined results: null or empty texts and texts without a letter are `und` with score 0; with no labelled row at all every text
is `und`; rows that repeat are labelled alike; ties go to the language first by code point.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.registry import query
from waymark.llm.textbytes import batched, fold, slices, widened

WINDOW = 64
HIDDEN = 8
UNKNOWN = "und"


def _init(langs: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    p: dict[str, np.ndarray] = {}
    for d in "fb":
        p[f"{d}e"] = rng.normal(0, 0.3, (256, 3 * HIDDEN))
        p[f"{d}u"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 3 * HIDDEN))
        p[f"{d}b"] = np.zeros(3 * HIDDEN)
    p["w"] = rng.normal(0, 0.3, (2 * HIDDEN, langs))
    p["c"] = np.zeros(langs)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _gradients(p: dict, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Loss and gradients for windows x (B, T) whose positions all carry label y (B)."""
    n, t_max = x.shape
    k = HIDDEN
    kept, states = {}, []
    for d in "fb":
        h, tape, out = np.zeros((n, k), np.float32), [], np.empty((t_max, n, k), np.float32)
        for t in range(t_max) if d == "f" else range(t_max - 1, -1, -1):
            g = p[f"{d}e"][x[:, t]] + p[f"{d}b"]
            a = h @ p[f"{d}u"]
            z, r = _sigmoid(g[:, :k] + a[:, :k]), _sigmoid(g[:, k:2 * k] + a[:, k:2 * k])
            c = np.tanh(g[:, 2 * k:] + r * a[:, 2 * k:])
            new = c + z * (h - c)
            tape.append((t, h, z, r, c, a[:, 2 * k:]))
            h = out[t] = new
        kept[d] = tape
        states.append(out)
    both = np.concatenate(states, 2)
    logits = both @ p["w"] + p["c"]
    logits -= logits.max(2, keepdims=True)
    prob = np.exp(logits)
    prob /= prob.sum(2, keepdims=True)
    rows = np.arange(n)
    loss = -np.log(prob[:, rows, y] + 1e-9).mean()
    prob[:, rows, y] -= 1
    prob /= n * t_max
    grads = {key: np.zeros_like(v) for key, v in p.items()}
    grads["w"] = np.einsum("tnk,tnl->kl", both, prob)
    grads["c"] = prob.sum((0, 1))
    upper = prob @ p["w"].T
    for i, d in enumerate("fb"):
        later = np.zeros((n, k), np.float32)
        at, flow = [], []
        for t, h, z, r, c, ac in reversed(kept[d]):
            dh = upper[t, :, i * k:(i + 1) * k] + later
            dz, dc = dh * (h - c) * z * (1 - z), dh * (1 - z) * (1 - c * c)
            dr = dc * ac * r * (1 - r)
            da = np.concatenate([dz, dr, dc * r], 1)
            grads[f"{d}u"] += h.T @ da
            later = dh * z + da @ p[f"{d}u"].T
            at.append(x[:, t])
            flow.append(np.concatenate([dz, dr, dc], 1))
        flow = np.concatenate(flow)
        np.add.at(grads[f"{d}e"], np.concatenate(at), flow)
        grads[f"{d}b"] = flow.sum(0)
    return float(loss), grads


def train(x: np.ndarray, y: np.ndarray, langs: int, steps: int = 500, batch: int = 64, rate: float = 0.02, seed: int = 3) -> dict:
    """Parameters after `steps` of Adam on windows x (N, WINDOW) of bytes with labels y."""
    rng = np.random.default_rng(seed)
    p = _init(langs, rng)
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(x), batch)
        _, grads = _gradients(p, x[pick], y[pick])
        now = rate * (1 - step / (steps + 1))
        for key, g in grads.items():
            m[key] += 0.1 * (g - m[key])
            v[key] += 0.01 * (g * g - v[key])
            p[key] -= now * (m[key] / (1 - 0.9**step)) / (np.sqrt(v[key] / (1 - 0.99**step)) + 1e-8)
    return p


def compiled(p: dict) -> dict:
    """Parameters in the layout that scoring uses: update and reset halved for tanh, biases added to the byte tables."""
    k, out = HIDDEN, {"w": p["w"], "c": p["c"]}
    for d in "fb":
        table = p[f"{d}e"] + p[f"{d}b"]
        out[d] = tuple(np.ascontiguousarray(a, np.float32) for a in (
            0.5 * table[:, :2 * k], table[:, 2 * k:], 0.5 * p[f"{d}u"][:, :k], 0.5 * p[f"{d}u"][:, k:2 * k], p[f"{d}u"][:, 2 * k:]))
    return out


def position_probabilities(model: dict, x: np.ndarray) -> np.ndarray:
    """(L, T, B) probabilities of windows x (T, B) of bytes."""
    t_max, n = x.shape
    k = HIDDEN
    both = np.empty((t_max, n, 2 * k), np.float32)
    for i, d in enumerate("fb"):
        gates, cand, uz, ur, uc = model[d]
        h = np.zeros((n, k), np.float32)
        g, c = np.empty((n, 2 * k), np.float32), np.empty((n, k), np.float32)
        for t in range(t_max) if d == "f" else range(t_max - 1, -1, -1):
            np.take(gates, x[t], axis=0, out=g, mode="clip")
            np.take(cand, x[t], axis=0, out=c, mode="clip")
            z, r = h @ uz, h @ ur
            z += g[:, :k]
            r += g[:, k:]
            np.tanh(z, out=z)
            np.tanh(r, out=r)
            r += 1
            r *= h @ uc
            r *= 0.5
            c += r
            np.tanh(c, out=c)
            z += 1
            z *= 0.5
            h -= c
            h *= z
            h += c
            both[t, :, i * k:(i + 1) * k] = h
    prob = model["w"].T @ both.reshape(-1, 2 * k).T
    prob += model["c"][:, None]
    prob -= prob.max(0)
    np.exp(prob, out=prob)
    prob /= prob.sum(0)
    return prob.reshape(-1, t_max, n)


def document_probabilities(model: dict, data: np.ndarray, offsets: np.ndarray, group: int = 1024) -> np.ndarray:
    """Mean of the positions' probabilities for each row; zeros for rows without bytes."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    owner = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[owner] + nth * WINDOW
    held = np.minimum(WINDOW, offsets[owner + 1] - start)
    padded = np.append(data, np.full(WINDOW, 32, np.uint8))
    out = np.zeros((len(size), len(model["c"])))
    steps = np.arange(WINDOW)[:, None]
    for at in range(0, len(owner), group):
        part = slice(at, at + group)
        x = padded[start[part] + steps]
        inside = steps < held[part]
        x[~inside] = 32
        prob = position_probabilities(model, x)
        prob *= inside
        for j, sums in enumerate(prob.sum(1)):
            out[:, j] += np.bincount(owner[part], sums, len(size))
    return out / np.maximum(size, 1)[:, None]


def training_windows(texts: list[tuple[int, str]], per_doc: int) -> np.ndarray:
    rows = []
    for key, text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        last = max(0, len(data) - WINDOW)
        for i in range(min(per_doc, 1 + last // WINDOW)):
            at = (abs(key) * 2654435761 + i * 40503 * 977) % (last + 1)
            w = np.full(WINDOW, 32, np.uint8)
            w[:len(data) - at] = data[at:at + WINDOW]
            rows.append(w)
    return np.array(rows, np.uint8).reshape(-1, WINDOW)


def fit(docs: DataFrame, per_lang: int = 300, per_doc: int = 6) -> tuple[list[str], dict] | None:
    """Languages and network learnt from rows (doc_id, text, lang); at most `per_lang` texts of each language come to the driver."""
    known = docs.filter("lang is not null and text is not null and doc_id is not null")
    langs = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    x, y = [], []
    for i, lang in enumerate(langs):
        key = F.xxhash64("doc_id", F.lit(5))
        # Which rows first, from narrow columns; then their texts.
        ids = known.filter(F.col("lang") == lang).select("doc_id", key.alias("key")).orderBy("key", "doc_id").limit(per_lang)
        got = known.filter(F.col("lang") == lang).select("doc_id", F.substring("text", 1, 1 << 16).alias("text")).join(
            F.broadcast(ids.distinct()), "doc_id").collect()
        w = training_windows(sorted((r["key"], r["text"]) for r in got), per_doc)
        x.append(w)
        y.append(np.full(len(w), i))
    if not langs:
        return None
    return langs, compiled(train(np.concatenate(x), np.concatenate(y), len(langs)))


def identify_language(docs: DataFrame, model: tuple[list[str], dict] | None, text: str = "text") -> DataFrame:
    """`docs` with lang_pred and score; older columns of these names are replaced."""
    docs = docs.drop("lang_pred", "score", "__letters")
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    spark = docs.sparkSession
    batched(spark)
    shared = spark.sparkContext.broadcast(model)
    marked = docs.withColumn("__letters", F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    at, names = docs.columns.index(text), [*docs.columns, "lang_pred", "score"]
    schema = widened(docs.schema, lang_pred="string", score="double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, net = shared.value
        labels = np.array([*langs, UNKNOWN], object)
        for b in batches:
            prob = np.zeros((b.num_rows, len(langs)))
            for row, data, offsets in slices(b.column(at)):
                prob[row:row + len(offsets) - 1] = document_probabilities(net, data, offsets)
            letters = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
            best = np.where(letters, prob.argmax(1), len(langs))
            score = np.where(letters, np.clip(prob.max(1), 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(labels[best], pa.string()), pa.array(score)], names)

    return marked.mapInArrow(run, schema)


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = fit(docs.filter(fold("doc_id", 4) != 2))
    return identify_language(docs.select("doc_id", "text"), model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
