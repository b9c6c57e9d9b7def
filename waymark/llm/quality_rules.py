"""Quality rules as a short-circuit cascade.

A rule rejects documents by integers counted in their text. What every rule costs and which documents it rejects is measured on a
sample; rules are then ordered greedily by rejection per cost: the next rule is the one that rejects most of the sampled documents still
alive for a second of its time, its features paid for only if no earlier rule needed them. In the run a rule sees only the documents
that no earlier rule rejected, and only their features are counted. A document is kept if no rule rejects it, so the order decides time and
which rule is named, never the verdict.

The sample has `SAMPLE` rows in the mean whatever the size of the input and stays in its tasks; a row of sums and patterns a rule set is all that reaches
the driver. Work in a task is done on slices of texts of bounded size (a longer text comes alone, at about 100 bytes a byte).

Defined results: a null text counts as empty and is rejected as too short; equal rows get equal verdicts; with an empty table the rules keep the order
given; words are `[^\\x20\\x09-\\x0D]+` and keep their case; older columns of the names that are added are replaced.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from waymark.llm.registry import query
from waymark.llm.textbytes import SPACE, batched, mix, run_hashes, salts, slices, widened, words

#: Rows of the sample in the mean, and the seed that draws them.
SAMPLE, SEED = 2000, 12
WINDOW = 8
NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True


def _marked(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters.encode())] = True
    return out


SYMBOL, BANG = _marked("#*$%&|<>"), _marked("!")
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LETTER = UPPER | np.roll(UPPER, 32)


class Texts:
    """Texts one after the other, and what has been counted in them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def take(self, rows: np.ndarray) -> Texts:
        if len(rows) == len(self):
            return self
        low, high = self.offsets[rows], self.offsets[rows + 1]
        parts = [self.data[a:z] for a, z in zip(low, high, strict=True)]
        return Texts(np.concatenate(parts) if parts else self.data[:0], np.append(0, np.cumsum(high - low)))

    def per_row(self, flags: np.ndarray, bounds: np.ndarray | None = None) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(flags))[self.offsets if bounds is None else bounds])

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return words(self.data, self.offsets)

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Start of every line with a word, and the lines of each row."""
        first = np.unique(np.concatenate([self.offsets[:-1][np.diff(self.offsets) > 0], np.flatnonzero(self.data[:-1] == 10) + 1])) if len(self.data) else self.offsets[:0]
        first = first[self.data[first] != 10]
        inside = np.append(0, np.cumsum(~SPACE[self.data]))
        stop = np.append(first[1:], len(self.data))
        return first, inside[stop] > inside[first]

    def n_words(self) -> np.ndarray:
        return self.words[2]

    def word_chars(self) -> np.ndarray:
        return self.per_row(~SPACE[self.data] & ((self.data & 0xC0) != 0x80))

    def n_symbols(self) -> np.ndarray:
        return self.per_row(SYMBOL[self.data])

    def n_bangs(self) -> np.ndarray:
        return self.per_row(BANG[self.data])

    def n_upper(self) -> np.ndarray:
        return self.per_row(UPPER[self.data])

    def n_letters(self) -> np.ndarray:
        return self.per_row(LETTER[self.data])

    def n_lines(self) -> np.ndarray:
        first, full = self.lines
        return np.diff(np.searchsorted(first[full], self.offsets))

    def n_dup_lines(self) -> np.ndarray:
        """Lines with a word that are equal to an earlier one of their text."""
        first, full = self.lines
        hashed = run_hashes(self.data, first, NEWLINE)[full]
        bounds = np.searchsorted(first[full], self.offsets)
        row = np.repeat(np.arange(len(self)), np.diff(bounds))
        order = np.lexsort((hashed, row))
        again = np.zeros(len(hashed), bool)
        again[order[1:]] = (hashed[order[1:]] == hashed[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
        return self.per_row(again, bounds)

    def n_echoes(self) -> np.ndarray:
        """Words equal to the word before them."""
        start, _, count = self.words
        hashed = run_hashes(self.data, start, SPACE)
        bounds = np.append(0, np.cumsum(count))
        same = np.append(False, hashed[1:] == hashed[:-1]) if len(hashed) else np.zeros(0, bool)
        same[bounds[:-1][count > 0]] = False
        return self.per_row(same, bounds)

    def n_repeat_words(self) -> np.ndarray:
        """Words in windows of eight that are found twice or more in their text."""
        start, _, count = self.words
        bounds = np.append(0, np.cumsum(count))
        if len(start) < WINDOW:
            return np.zeros(len(self), np.int64)
        row = np.repeat(np.arange(len(self)), count)
        at = np.flatnonzero(row[:len(row) - WINDOW + 1] == row[WINDOW - 1:])
        hashed = run_hashes(self.data, start, SPACE)
        keys = row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k, salt in enumerate(salts(WINDOW, 3)):
            keys += hashed[at + k] * (salt | np.uint64(1))
        keys = mix(keys)
        order = np.argsort(keys)
        same = keys[order[1:]] == keys[order[:-1]]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        change = np.zeros(len(start) + 1, np.int64)
        np.add.at(change, at[twice], 1)
        np.add.at(change, at[twice] + WINDOW, -1)
        return self.per_row(np.cumsum(change[:-1]) > 0, bounds)


Counts = dict[str, np.ndarray]


@dataclass(frozen=True)
class Rule:
    """`rejects` tells from the features named in `needs` (methods of Texts) which documents go."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Counts], np.ndarray]


#: Rules of the query; the first two are its base.
RULES = (
    Rule("short", ("n_words",), lambda c: c["n_words"] < 20),
    Rule("repetitive", ("n_words", "n_repeat_words"), lambda c: 100 * c["n_repeat_words"] > 30 * c["n_words"]),
    Rule("symbols", ("n_words", "n_symbols"), lambda c: 10 * c["n_symbols"] > c["n_words"]),
    Rule("word length", ("n_words", "word_chars"), lambda c: (c["word_chars"] < 2 * c["n_words"]) | (c["word_chars"] > 20 * c["n_words"])),
    Rule("repeated lines", ("n_lines", "n_dup_lines"), lambda c: 100 * c["n_dup_lines"] > 50 * c["n_lines"]),
    Rule("echoes", ("n_words", "n_echoes"), lambda c: 100 * c["n_echoes"] > 30 * c["n_words"]),
    Rule("shouting", ("n_upper", "n_letters"), lambda c: 2 * c["n_upper"] > c["n_letters"]),
    Rule("exclaiming", ("n_words", "n_bangs"), lambda c: 10 * c["n_bangs"] > c["n_words"]),
)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def ordered(rules: tuple[Rule, ...], seconds: dict[str, float], patterns: Counter) -> tuple[Rule, ...]:
    """Rules by rejection per cost. `seconds` is what each feature took on the sample; `patterns` counts sampled documents by the set of
    rules, as bits in the order of `rules`, that reject them. Equal rates keep the order given."""
    left, paid, out = list(range(len(rules))), set(), []
    alive = dict(patterns)

    def rate(i: int) -> float:
        lost = sum(n for bits, n in alive.items() if bits >> i & 1)
        return lost / (sum(seconds.get(f, 0.0) for f in rules[i].needs if f not in paid) + 1e-9 * (1 + len(rules[i].needs)))

    while left:
        best = max(left, key=lambda i: (rate(i), -i))
        left.remove(best)
        out.append(rules[best])
        paid.update(rules[best].needs)
        alive = {bits: n for bits, n in alive.items() if not bits >> best & 1}
    return tuple(out)


def plan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample: DataFrame | None = None) -> tuple[Rule, ...]:
    """`rules` in the order measured on `sample`, by default `SAMPLE` rows drawn from `docs`, which takes one more scan of the texts."""
    batched(docs.sparkSession)
    if sample is None:
        sample = docs.select(text).sample(min(1.0, SAMPLE / max(1, docs.count())), SEED)
    needed = sorted({f for r in rules for f in r.needs})

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        took, seen = Counter(), Counter()
        for b in batches:
            for _, data, offsets in slices(b.column(0)):
                counted: Counts = {}
                for feature in needed:
                    # Made anew each time: a feature that shares nothing pays for its words itself.
                    texts, begin = Texts(data, offsets), time.perf_counter()
                    counted[feature] = getattr(texts, feature)()
                    took[feature] += time.perf_counter() - begin
                bits = sum(r.rejects(counted).astype(np.int64) << i for i, r in enumerate(rules))
                seen.update(bits.tolist())
        yield pa.RecordBatch.from_arrays([
            pa.array(list(took) + [None] * len(seen), pa.string()), pa.array(list(took.values()) + [0.0] * len(seen), pa.float64()),
            pa.array([None] * len(took) + list(seen), pa.int64()), pa.array([0] * len(took) + list(seen.values()), pa.int64())], ["feature", "took", "bits", "n"])

    got = sample.select(text).mapInArrow(measure, "feature string, took double, bits long, n long").groupBy("feature", "bits").agg({"took": "sum", "n": "sum"}).collect()
    return ordered(rules, {r["feature"]: r["sum(took)"] for r in got if r["feature"]}, Counter({r["bits"]: r["sum(n)"] for r in got if r["bits"] is not None}))


def cascade(texts: Texts, rules: tuple[Rule, ...]) -> tuple[np.ndarray, Counts, Counts]:
    """Number of the rule that rejects each text (-1: none), the features counted on the way and for which texts they were."""
    verdict = np.full(len(texts), -1)
    counted: Counts = {}
    known: Counts = {}
    alive, left = np.arange(len(texts)), texts
    for number, rule in enumerate(rules):
        if not len(alive):
            break
        for feature in rule.needs:
            if feature not in counted:
                counted[feature], known[feature] = np.zeros(len(texts), np.int64), np.zeros(len(texts), bool)
                counted[feature][alive], known[feature][alive] = getattr(left, feature)(), True
        gone = rule.rejects({f: counted[f][alive] for f in rule.needs})
        if gone.any():
            verdict[alive[gone]] = number
            stay = np.flatnonzero(~gone)
            alive, left = alive[stay], left.take(stay)
    return verdict, counted, known


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...], text: str = "text", features: tuple[str, ...] = ()) -> DataFrame:
    """`docs` with kept, rejected_by (the first rule in this order that rejects, null if none) and rules_run, and with `features` counted for every document,
    also for those that were rejected before a rule asked for them."""
    batched(docs.sparkSession)
    added = (*features, "kept", "rejected_by", "rules_run")
    docs = docs.drop(*added)
    at = docs.columns.index(text)
    schema = widened(docs.schema, **{f: "long" for f in features}, kept="boolean").add("rejected_by", "string")
    schema = widened(schema, rules_run="integer")
    names = pa.array([r.name for r in rules], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, data, offsets in slices(b.column(at)):
                texts = Texts(data, offsets)
                verdict, counted, known = cascade(texts, rules)
                for feature in features:
                    have = known.get(feature, np.zeros(len(texts), bool))
                    values = counted.get(feature, np.zeros(len(texts), np.int64))
                    late = np.flatnonzero(~have)
                    if len(late):
                        values[late] = getattr(texts.take(late), feature)()
                    counted[feature] = values
                out = [pa.array(counted[f], pa.int64()) for f in features]
                out += [pa.array(verdict < 0), names.take(pa.array(verdict, pa.int64(), mask=verdict < 0)),
                        pa.array(np.where(verdict < 0, len(rules), verdict + 1).astype(np.int32))]
                part = b.slice(row, len(texts))
                yield pa.RecordBatch.from_arrays(list(part.columns) + out, b.schema.names + list(added))

    return docs.mapInArrow(run, schema)


ORACLE = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS x FROM split),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
counted AS (
  SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
    length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters, length(regexp_replace(t, '[^!]', '', 'g')) AS n_bangs,
    len(list_filter(w, lambda x, i: i > 1 AND x = w[i - 1])) AS n_echoes
  FROM split s LEFT JOIN covered c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR 100 * n_dup_lines > 50 * n_lines OR 2 * n_upper > n_letters OR 10 * n_bangs > n_words
    OR 100 * n_echoes > 30 * n_words) AS kept
FROM counted"""


@query("op12_quality_rules", ORACLE)
def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    judged = apply_rules(docs, plan(docs), features=BASE)
    failed = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed"
    return judged.selectExpr("doc_id", *BASE, failed, "kept")
