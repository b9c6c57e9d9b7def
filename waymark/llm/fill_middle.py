"""Fill-in-the-middle transformation of documents by a piece table.

A document becomes descriptors (buffer, start, length) in bytes over two immutable buffers: its own text and the sentinels.
Cutting splits the descriptor that covers a place, an arrangement permutes the descriptors of prefix, middle and suffix behind their sentinels, and
a text comes into being only when descriptors are read one after the other, into an output or into a hash. The way back
finds the sentinels in an output, describes what lies between them and puts these descriptors through the inverse permutation.

The two cuts and the form are drawn from a keyed SHA-256 of the document's id, so that reruns and lost tasks give the same
output. Cuts lie between units, here lines with their line ends. A row is worked on alone: memory is bounded by the longest text.

Defined results: a null or empty text and one that contains a sentinel are `plain`, their output is the text (empty for null);
a null id is hashed as an empty one; rows that share an id share draws, each with its own text; older columns of the names that are added are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, StructType

from waymark.llm.registry import query
from waymark.llm.textbytes import batched, slices, widened

#: Sentinels of prefix, middle and suffix, and the buffer that holds them.
SENTINELS = (b"<P>", b"<M>", b"<S>")
MARKS = b"".join(SENTINELS)
#: Which part stands where, by form.
ORDERS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
TEXT, MARK = 0, 1
Piece = tuple[int, int, int]


def split(pieces: list[Piece], place: int) -> tuple[list[Piece], list[Piece]]:
    """The pieces before and after `place`, a byte of the document; the piece that covers it becomes two."""
    before: list[Piece] = []
    for i, (buffer, start, length) in enumerate(pieces):
        if place < length:
            rest = [(buffer, start + place, length - place)] + pieces[i + 1:]
            return before + ([(buffer, start, place)] if place else []), rest
        before.append((buffer, start, length))
        place -= length
    return before, []


def arranged(parts: list[list[Piece]], form: str) -> list[Piece]:
    """Pieces of the output: every part behind its sentinel, in the order of `form`."""
    out: list[Piece] = []
    for part in ORDERS[form]:
        out.append((MARK, sum(map(len, SENTINELS[:part])), len(SENTINELS[part])))
        out += parts[part]
    return out


def undone(output: bytes, form: str) -> list[Piece]:
    """Pieces of the text over an output of `form`: what lies between its sentinels, in the order of the text."""
    if form == "plain":
        return [(TEXT, 0, len(output))] if output else []
    found, at = {}, 0
    for part in ORDERS[form]:
        at = output.index(SENTINELS[part], at)
        found[part] = (at, at + len(SENTINELS[part]))
        at = found[part][1]
    ends = [found[part][0] for part in ORDERS[form][1:]] + [len(output)]
    spans = {part: (TEXT, found[part][1], end - found[part][1]) for part, end in zip(ORDERS[form], ends, strict=True)}
    return [spans[part] for part in range(len(SENTINELS)) if spans[part][2]]


def read(pieces: list[Piece], text: bytes) -> Iterator[memoryview]:
    """The bytes described, piece by piece, without a copy."""
    buffers = (memoryview(text), memoryview(MARKS))
    for buffer, start, length in pieces:
        yield buffers[buffer][start:start + length]


def digest(pieces: list[Piece], text: bytes) -> str:
    out = hashlib.sha256()
    for part in read(pieces, text):
        out.update(part)
    return out.hexdigest()


def draws(doc_id: object, seed: int) -> list[int]:
    """Four 32-bit numbers of a document."""
    hashed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(hashed[i:i + 4], "big") for i in (0, 4, 8, 12)]


def unit_ends(body: np.ndarray) -> np.ndarray:
    """Where each line ends, its line end included."""
    ends = np.flatnonzero(body == 10) + 1
    return ends if not len(body) or body[-1] == 10 else np.append(ends, len(body))


def described(doc_id: object, body: np.ndarray, text: bytes, seed: int, share: int, spm: int) -> tuple[int, str, list[Piece], int | None, int | None]:
    """(units, form, pieces of the output, code points of prefix and of middle, null if plain)."""
    ends = unit_ends(body)
    whole = [(TEXT, 0, len(text))] if text else []
    first, second, chosen, kind = draws(doc_id, seed)
    if not text or chosen % 100 >= share or any(mark in text for mark in SENTINELS):
        return len(ends), "plain", whole, None, None
    form = "spm" if kind % 100 < spm else "psm"
    bounds = np.append(0, ends)
    low, high = sorted(int(bounds[draw % (len(ends) + 1)]) for draw in (first, second))
    head, suffix = split(whole, high)
    prefix, middle = split(head, low)
    begins = (body & 0xC0) != 0x80
    return len(ends), form, arranged([prefix, middle, suffix], form), int(begins[:low].sum()), int(begins[low:high].sum())


def _rows(batch: pa.RecordBatch, id_at: int, text_at: int, seed: int, share: int, spm: int) -> Iterator[tuple]:
    """(units, form, prefix, middle, pieces, text) of every row."""
    ids = batch.column(id_at)
    for row, data, offsets in slices(batch.column(text_at)):
        for i in range(len(offsets) - 1):
            body = data[offsets[i]:offsets[i + 1]]
            text = body.tobytes()
            n, form, pieces, prefix, middle = described(ids[row + i].as_py(), body, text, seed, share, spm)
            yield n, form, prefix, middle, pieces, text


def fill_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 7, share: int = 100, spm: int = 50) -> DataFrame:
    """`docs` with n, form, prefix_chars, middle_chars, fim_text (the output) and pieces (buffer 0 for the text and 1 for the
    sentinels, start, length). `share` of a hundred documents are rearranged, `spm` of a hundred of these with the suffix first."""
    batched(docs.sparkSession)
    added = ("n", "form", "prefix_chars", "middle_chars", "fim_text", "pieces")
    docs = docs.drop(*added)
    at, body = docs.columns.index(doc_id), docs.columns.index(text)
    kind = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))
    schema = widened(docs.schema, n="long", form="string").add("prefix_chars", "long").add("middle_chars", "long")
    schema = widened(schema, fim_text="string").add("pieces", ArrayType(StructType().add("buffer", "integer").add("start", "long").add("length", "long")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(n, form, prefix, middle, b"".join(read(pieces, whole)).decode(), [dict(zip(("buffer", "start", "length"), p, strict=True)) for p in pieces])
                    for n, form, prefix, middle, pieces, whole in _rows(b, at, body, seed, share, spm)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(added)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), kind)
            yield pa.RecordBatch.from_arrays(list(b.columns) + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], b.schema.names + list(added))

    return docs.mapInArrow(run, schema)


def restore(outputs: DataFrame, output: str = "fim_text", form: str = "form") -> DataFrame:
    """`outputs` with `restored`: the texts, from output and form alone. A null output or form gives null; a form that is not known
    or an output without its sentinels fails."""
    batched(outputs.sparkSession)
    outputs = outputs.drop("restored")
    at, kind = outputs.columns.index(output), outputs.columns.index(form)
    schema = widened(outputs.schema).add("restored", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for value, known in zip(b.column(at), b.column(kind).to_pylist(), strict=True):
                raw = None if value.as_py() is None or known is None else value.as_py().encode()
                texts.append(None if raw is None else b"".join(read(undone(raw, known), raw)).decode())
            yield pa.RecordBatch.from_arrays(list(b.columns) + [pa.array(texts, pa.string())], b.schema.names + ["restored"])

    return outputs.mapInArrow(run, schema)


def fill_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 7, share: int = 100, spm: int = 50) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256): outputs are hashed from their pieces, then written and undone
    one at a time, so that no output leaves its task."""
    batched(docs.sparkSession)
    narrow = docs.select(doc_id, text)
    kind = narrow.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for n, form, prefix, middle, pieces, whole in _rows(b, 0, 1, seed, share, spm):
                output = whole if form == "plain" else b"".join(read(pieces, whole))
                rows.append((n, form, prefix, middle, digest(pieces, whole), digest(undone(output, form), output)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0)] + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"])

    return narrow.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")


ORACLE = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
drawn AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || substr(x, 1, 8))::BIGINT % (len(u) + 1) AS a, ('0x' || substr(x, 9, 8))::BIGINT % (len(u) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(x, 17, 8))::BIGINT % 100 >= 100 THEN 'plain'
      WHEN ('0x' || substr(x, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM units),
parts AS (
  SELECT doc_id, t, n, form, coalesce(array_to_string(u[1:least(a, b)], ''), '') AS p,
    coalesce(array_to_string(u[least(a, b) + 1:greatest(a, b)], ''), '') AS m, coalesce(array_to_string(u[greatest(a, b) + 1:n], ''), '') AS s FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CAST(CASE WHEN form <> 'plain' THEN length(p) END AS BIGINT) AS prefix_chars,
  CAST(CASE WHEN form <> 'plain' THEN length(m) END AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM parts"""


@query("op11_fill_middle", ORACLE)
def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
