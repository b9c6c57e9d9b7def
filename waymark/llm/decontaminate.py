"""Benchmark decontamination: the CGK embedding, bit-sampling LSH over windows, exact edit distance.

Texts and items are brought to a normal form (A-Z lower-cased, one space between words) and compared as bytes. A random walk reads
a window: step j emits the byte under the pointer and, by a random bit for (j, byte), moves on or stays. Strings few edits apart walk
together again after an edit, so edit distance becomes Hamming distance between walks; a key is a hash of some sampled steps alone. Several walks are
taken and several samples of each walk's steps, by classes of item length (`CLASSES`), so that an item within the tolerance is
found with a probability of at least 0.97. The windows of short items are as long as they are. At one edit in ten bytes two walks of more than some 20 bytes seldom
meet again, so longer items are covered by windows from each of their words. Windows of documents begin at words too, at every character of scripts
that write without blanks, and at every character of a word beyond its 24th byte. Only classes that the benchmark has are walked.
Items under the first class are matched exactly, as whole words.

The benchmark comes in blocks of bounded size. A block's keys, sorted, are broadcast and met by all documents in one pass without a shuffle:
a task looks windows up, puts the places of an item that lie near each other together, tests shared 4-grams (a condition that no pair
within the tolerance fails) and decides by the exact edit distance between the item and the best matching part of the text it holds. Only
matches leave it.

Defined results: null or empty texts are clean; null or empty items match nothing; items with equal texts are all named; rows that
share a doc_id are judged together; columns other than the id and the text are left aside.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.registry import query
from waymark.llm.textbytes import batched, mix, normal, salts, slices, word_hashes, words
from waymark.session import cut

#: By least item length in bytes: steps of a walk, number of walks, samples of each and steps sampled for a key.
CLASSES = {14: (24, 12, 2, 9), 24: (24, 6, 2, 10), 48: (40, 4, 2, 14)}
#: Bytes of items in a block, in the mean, and windows walked at once.
ITEM_BYTES, WINDOWS = 2 << 20, 1 << 15
#: A word is entered at every character from this byte on.
INNER = 24
GRAM = 4


@dataclass(frozen=True)
class Walk:
    moves: np.ndarray
    samples: list[tuple[int, np.ndarray]]


def _walks(steps: int, number: int, samples: int, sampled: int) -> list[Walk]:
    out = []
    for n in range(number):
        rng = np.random.default_rng(1000 * steps + n)
        moves = rng.integers(0, 2, (steps, 256)).astype(np.uint8)
        drawn = []
        for salt in salts(samples, 1000 * steps + n):
            chosen = np.zeros(steps, bool)
            chosen[rng.permutation(steps)[:sampled]] = True
            drawn.append((int(salt), chosen))
        out.append(Walk(moves, drawn))
    return out


WALKS = {least: _walks(*shape) for least, shape in CLASSES.items()}


def window_keys(padded: np.ndarray, start: np.ndarray, walk: Walk) -> tuple[list[np.ndarray], np.ndarray]:
    """A key a sample for the window at each start, and where the walk ends. `padded` goes on for the walk's steps after the last start."""
    at = start.astype(np.int32)
    keys = [np.full(len(start), salt, np.uint64) for salt, _ in walk.samples]
    for j, moves in enumerate(walk.moves):
        byte = padded[at]
        for key, (_, chosen) in zip(keys, walk.samples, strict=True):
            if chosen[j]:
                key *= np.uint64(0x9E3779B97F4A7C15)
                key += byte
        at += moves[byte]
    return [mix(key) for key in keys], at


def starts(flat: np.ndarray) -> np.ndarray:
    """Where windows begin in texts of normal form, zeros or spaces between them."""
    if not len(flat):
        return np.zeros(0, np.int64)
    place = np.arange(len(flat))
    edge = np.append(32, flat[:-1])
    edge = (edge == 32) | (edge == 0)
    inner = (place - np.maximum.accumulate(np.where(edge, place, 0)) >= INNER) & ((flat & 0xC0) != 0x80)
    return np.flatnonzero((edge | (flat >= 0xE0) | inner) & (flat != 32) & (flat != 0))


def normal_items(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, body, names): one row per distinct normal form that is not empty; names lists the ids that have it."""
    kind = benchmark.schema[item_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, data, offsets in slices(b.column(1)):
                flat, bounds = normal(data, *words(data, offsets))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(row, len(bounds) - 1), pa.array(
                    [flat[a:max(a, z - 1)].tobytes() for a, z in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())], ["name", "body"])

    bodies = benchmark.select(item_id, text).mapInArrow(run, f"name {kind}, body binary").filter(F.octet_length("body") > 0)
    return bodies.groupBy("body").agg(F.array_sort(F.collect_set("name")).alias("names")).select(F.xxhash64("body").alias("item"), "body", "names")


def _grams(x: np.ndarray) -> np.ndarray:
    """16-bit hashes of the 4-grams."""
    if len(x) < GRAM:
        return np.zeros(0, np.uint16)
    x = x.astype(np.uint32)
    whole = sum(x[j:len(x) - GRAM + 1 + j] << np.uint32(8 * j) for j in range(GRAM))
    return (whole * np.uint32(2654435761) >> np.uint32(16)).astype(np.uint16)


def edit_distance(item: np.ndarray, part: np.ndarray, most: int | None = None) -> int:
    """Smallest edit distance between `item` and any substring of `part`; some number above `most` if it is above."""
    place = np.arange(len(part) + 1)
    row = np.zeros(len(part) + 1, np.int64)
    for i, byte in enumerate(item, 1):
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (part != byte))
        new[0] = i
        row = np.minimum.accumulate(new - place) + place
        if most is not None and i % 16 == 0 and row.min() > most:
            break
    return int(row.min())


def best_match(item: bytes, part: bytes, most: int, grams: np.ndarray | None = None) -> int | None:
    """The distance if it is at most `most`."""
    if item in part:
        return 0
    x, y = np.frombuffer(item, np.uint8), np.frombuffer(part, np.uint8)
    held = np.zeros(1 << 16, bool)
    held[_grams(y)] = True
    own = _grams(x) if grams is None else grams
    if held[own].sum() < len(own) - GRAM * most:
        return None
    found = edit_distance(x, y, most)
    return found if found <= most else None


@dataclass
class Keys:
    """Sorted keys of one class with the item and the place in it, and leading bits that tell most other keys at once."""

    key: np.ndarray
    item: np.ndarray
    at: np.ndarray
    bits: np.ndarray
    down: np.uint64

    @staticmethod
    def of(key: np.ndarray, item: np.ndarray, at: np.ndarray) -> Keys:
        order = np.argsort(key, kind="stable")
        leading = min(24, len(key).bit_length() + 8)
        bits = np.zeros(1 << leading, bool)
        bits[key >> np.uint64(64 - leading)] = True
        return Keys(key[order], item[order].astype(np.int32), at[order].astype(np.int32), bits, np.uint64(64 - leading))

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the given key, item, place in it) of every agreement."""
        some = np.flatnonzero(self.bits[key >> self.down])
        low, high = (np.searchsorted(self.key, key[some], side) for side in ("left", "right"))
        n = high - low
        entry = np.repeat(low - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        return np.repeat(some, n), self.item[entry], self.at[entry]


@dataclass
class Index:
    """A block of items by normal form: keys by class, hashes of short items by their number of words."""

    bodies: list[bytes]
    items: np.ndarray
    classes: dict[int, Keys] = field(default_factory=dict)
    phrases: dict[int, Keys] = field(default_factory=dict)

    @staticmethod
    def of(items: np.ndarray, bodies: list[bytes]) -> Index:
        out = Index(bodies, items)
        size = np.array([len(b) for b in bodies])
        kind = np.searchsorted(list(CLASSES), size, "right") - 1
        for number, least in enumerate(CLASSES):
            own = np.flatnonzero(kind == number)
            if not len(own):
                continue
            steps = CLASSES[least][0]
            flat = np.frombuffer(b"".join(bodies[i] + bytes(steps) for i in own), np.uint8)
            end = np.cumsum(size[own] + steps) - steps
            start = starts(flat)
            owner = np.searchsorted(end, start, "right")
            found = []
            for walk in WALKS[least]:
                for keys, stop in ((k, s) for ks, s in [window_keys(np.append(flat, np.zeros(steps, np.uint8)), start, walk)] for k in ks):
                    # Windows within the item, and the one from its beginning even if it reads on.
                    inside = (stop <= end[owner]) | (start == end[owner] - size[own][owner])
                    found.append((keys[inside], own[owner[inside]], (start - (end - size[own])[owner])[inside]))
            out.classes[least] = Keys.of(*[np.concatenate(c) for c in zip(*found, strict=True)])
        short: dict[int, list[tuple[int, int]]] = {}
        for i in np.flatnonzero(kind < 0):
            hashed = word_hashes(*_word_starts(np.frombuffer(bodies[i] + b" ", np.uint8)))
            short.setdefault(len(hashed), []).append((int(_phrase_hashes(hashed, len(hashed))[0]), int(i)))
        for n, rows in short.items():
            out.phrases[n] = Keys.of(np.array([h for h, _ in rows], np.uint64), np.array([i for _, i in rows]), np.zeros(len(rows), np.int64))
        return out


def _word_starts(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return flat, np.flatnonzero((np.append(32, flat[:-1]) == 32) & (flat != 32))


def _phrase_hashes(hashed: np.ndarray, n: int) -> np.ndarray:
    """Hash of the `n` words from each word on."""
    out = np.zeros(max(0, len(hashed) - n + 1), np.uint64)
    for k, salt in enumerate(salts(n, 6)):
        out += hashed[k:len(hashed) - n + 1 + k] * (salt | np.uint64(1))
    return mix(out)


def _candidates(index: Index, flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item, place where the item would begin) of all keys that agree."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64))]
    begin = starts(flat)
    for least, keys in index.classes.items():
        padded = np.append(flat, np.zeros(CLASSES[least][0], np.uint8))
        for start in (begin[i:i + WINDOWS] for i in range(0, len(begin), WINDOWS)):
            for walk in WALKS[least]:
                for key in window_keys(padded, start, walk)[0]:
                    window, item, at = keys.find(key)
                    if len(window):
                        found.append((np.searchsorted(bounds, start[window], "right") - 1, item, start[window] - at))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def matches(index: Index, flat: np.ndarray, bounds: np.ndarray, tolerance: float) -> dict[tuple[int, int], int]:
    """Smallest distance by (row, item) of what the texts of normal form hold within the tolerance."""
    best: dict[tuple[int, int], int] = {}
    if index.phrases:
        hashed = word_hashes(*_word_starts(flat))
        begin = _word_starts(flat)[1]
        for n, keys in index.phrases.items():
            window, item, _ = keys.find(_phrase_hashes(hashed, n))
            row = np.searchsorted(bounds, begin[window], "right") - 1
            for w, r, i in zip(window, row, item, strict=True):
                body = index.bodies[i]
                if (int(r), int(i)) not in best and begin[w] + len(body) < bounds[r + 1] and flat[begin[w]:begin[w] + len(body) + 1].tobytes() == body + b" ":
                    best[int(r), int(i)] = 0
    row, item, place = _candidates(index, flat, bounds)
    if not len(row):
        return best
    size = np.array([len(b) for b in index.bodies])
    order = np.lexsort((place, item, row))
    row, item, place = row[order], item[order], place[order]
    # Places near each other are verified together, in stretches of a few times the item.
    far = np.append(True, (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (place[1:] - place[:-1] > size[item[1:]])
                    | (place[1:] // (4 * size[item[1:]]) != place[:-1] // (4 * size[item[1:]])))
    first = np.flatnonzero(far)
    last = np.append(first[1:], len(row)) - 1
    grams: dict[int, np.ndarray] = {}
    for a, z in zip(first, last, strict=True):
        r, i = int(row[a]), int(item[a])
        if best.get((r, i)) == 0:
            continue
        body = index.bodies[i]
        most = int(len(body) * tolerance)
        if i not in grams:
            grams[i] = _grams(np.frombuffer(body, np.uint8))
        part = flat[max(bounds[r], place[a] - most):min(bounds[r + 1], max(bounds[r], place[z]) + len(body) + most)].tobytes()
        got = best_match(body, part, most, grams[i])
        if got is not None:
            best[r, i] = min(got, best.get((r, i), got))
    return best


def _matched(docs: DataFrame, index: Index, text: str, tolerance: float) -> DataFrame:
    """(doc_id, item, distance) of the documents that hold an item of the block."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for b in batches:
            for row, data, offsets in slices(b.column(1)):
                got = matches(index, *normal(data, *words(data, offsets)), tolerance)
                if got:
                    yield pa.RecordBatch.from_arrays([
                        b.column(0).take(pa.array([row + r for r, _ in got], pa.int64())), pa.array(index.items[[i for _, i in got]], pa.int64()),
                        pa.array(list(got.values()), pa.int32())], ["doc_id", "item", "distance"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text).mapInArrow(find, f"doc_id {kind}, item long, distance int")


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", tolerance: float = 0.1, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(doc_id, items, distance) of the documents that hold an item up to `tolerance` edits per byte: the ids of the items and the
    smallest distance. Every block of about `item_bytes` of items takes a pass over the documents."""
    batched(docs.sparkSession)
    items = cut(normal_items(benchmark))
    total = items.agg(F.sum(F.octet_length("body"))).first()[0]
    kind = benchmark.schema["item_id"].dataType.simpleString()
    if total is None:
        return docs.select("doc_id").limit(0).withColumns({"items": F.array().cast(f"array<{kind}>"), "distance": F.lit(0)})
    blocks = -(-total // item_bytes)
    found = None
    for block in range(blocks):
        held = items.filter(F.pmod("item", F.lit(blocks)) == block).select("item", "body").toArrow()
        if held.num_rows:
            some = cut(_matched(docs, Index.of(held.column("item").to_numpy(), held.column("body").to_pylist()), text, tolerance))
            found = some if found is None else found.unionByName(some)
    named = found.join(items.select("item", F.explode("names").alias("name")), "item")
    return cut(named.groupBy("doc_id").agg(F.array_sort(F.collect_set("name")).alias("items"), F.min("distance").alias("distance")))


@query("op6_decontaminate")
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).withColumnRenamed("doc_id", "id")
    return docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("id")), "left").select(
        "doc_id", F.col("distance").isNotNull().alias("contaminated"), F.size(F.coalesce("items", F.array())).alias("n_items"), "items", "distance")
