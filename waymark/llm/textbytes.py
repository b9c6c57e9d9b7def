"""UTF-8 bytes of Arrow text columns as numpy arrays: words, word hashes, normal form.

Words are maximal runs of bytes outside 0x20 and 0x09-0x0D; A-Z is lower-cased. Multi-byte characters never hold such
bytes, so byte runs and character runs agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLICE_BYTES = 1 << 19
WORD = r"[^\x20\x09-\x0D]+"

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def salts(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def planes(values: np.ndarray) -> bytes:
    """Bytes of the values, first bytes first, so that leading zeros lie together and Spark's compression takes them out."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


_BYTE = salts(256, 1)
_BYTE[SPACE] = 0
_LOWER_BYTE = _BYTE[LOWER]
_ODD = 0x9E3779B97F4A7C15 | 1
#: Powers for the bytes of a slice, and their inverses times the first one.
_POWER = np.cumprod(np.full(SLICE_BYTES, _ODD, np.uint64))
_BACK = np.cumprod(np.append(np.uint64(1), np.full(SLICE_BYTES - 1, pow(_ODD, -1, 1 << 64), np.uint64)))


def batched(spark: SparkSession, rows: int = 1000, size: str = "16m") -> None:
    """Bounds what one Arrow batch holds, whatever the length of texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def widened(schema: StructType, **kinds: str) -> StructType:
    """A copy of `schema` with further columns that are never null."""
    out = StructType(list(schema.fields))
    for name, kind in kinds.items():
        out.add(name, kind, False)
    return out


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's text, modulo; a null id is in no held-out fold."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus, F.lit(-1))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) of runs of rows that hold about `limit` bytes; a longer text comes alone.
    Null texts count as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    large = pa.types.is_large_string(texts.type)
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, np.int64 if large else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
        row = stop


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words of each row."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets) - 1, np.int64)
    inside = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:n]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.diff(np.searchsorted(start, offsets))


def word_hashes(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """64-bit hash of every lower-cased word; whitespace between words adds nothing."""
    if not len(start):
        return np.zeros(0, np.uint64)
    body = data[start[0]:]
    at = start - start[0]
    size = np.diff(np.append(at, len(body)))
    if len(body) <= len(_POWER) and size.max() <= 1 << 16:
        # Powers by the place in `body`, taken back by that of the word's first byte.
        return mix(np.add.reduceat(_LOWER_BYTE[body] * _POWER[:len(body)], at) * _BACK[at])
    place = np.arange(len(body)) - np.repeat(at, size)
    terms = _LOWER_BYTE[body] * (_POWER[place & 0xFFFF] + (place >> 16).astype(np.uint64) * np.uint64(2))
    return mix(np.add.reduceat(terms, at))


def run_hashes(data: np.ndarray, start: np.ndarray, silent: np.ndarray) -> np.ndarray:
    """64-bit hash of every run of bytes as it stands; between the end of a run and the next start there are only bytes marked in `silent`."""
    if not len(start):
        return np.zeros(0, np.uint64)
    table = salts(256, 2)
    table[silent] = 0
    body = data[start[0]:]
    at = start - start[0]
    place = np.arange(len(body)) - np.repeat(at, np.diff(np.append(at, len(body))))
    return mix(np.add.reduceat(table[body] * (_POWER[place & 0xFFFF] + (place >> 16).astype(np.uint64) * np.uint64(2)), at))


def normal(data: np.ndarray, start: np.ndarray, end: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased words, each followed by one space; with row offsets. A row without words is empty."""
    size = end - start + 1
    total = np.cumsum(size)
    bounds = np.append(0, total)[np.append(0, np.cumsum(count))]
    out = np.full(int(total[-1]) if len(total) else 0, 32, np.uint8)
    if len(total):
        first = total - size
        source = np.arange(len(out)) + np.repeat(start - first, size)
        last = total - 1
        source[last] = 0
        out = LOWER[data[source]]
        out[last] = 32
    return out, bounds
