"""Token counts of a byte-level BPE vocabulary by compiled finite-state transducers.

Two deterministic transducers do the work. The first reads character classes and emits one mark wherever a pre-token starts.
A chunk of text is a map from entry state to exit state; maps of all chunks are computed side by side, composed by a parallel
prefix scan, and a second pass from the then known entry states emits the marks. Chunks, not texts, are the unit, so one very
long text is as parallel as many short ones.

The second reads the bytes of a pre-token and annotates every transition with the number of tokens it adds. A state holds the
longest suffix read that begins a token and, for each of its suffixes that does so too, the last token and the count before
it; two tokens may stand side by side if no merge across their seam comes before the merges that build them. States are
determinised when first met and kept; counts of pre-tokens are kept by hash. Both stores are emptied when large, which costs
time but never changes a count.

Character classes are read off the library's own pre-tokenizer, one code point each, since they follow its Unicode version.

Defined results: null and empty texts have 0 bytes and 0 tokens; the added special string inside a text is one token, as the
library's default has it; rows that repeat are counted alike.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.registry import query
from waymark.llm.textbytes import batched, mix, salts, slices, widened

VOCABULARY = "byte_bpe_50k.json"
CHUNK = 64
KEPT_WORDS, KEPT_STATES = 500_000, 150_000

# Character classes, then the symbols that the first transducer reads. "Last" whitespace stands before a non-space.
LETTER, NUMBER, OTHER, BLANK, SPACE = range(5)
S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_SPACE_LAST, S_BLANK_LAST, S_BLANK, S_INSIDE = range(9)
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_BLANKS, TAIL_1, TAIL_2 = range(8)
STATES, SYMBOLS = 8, 9
RESET = SYMBOLS
# Fixed values of the vocabulary's pre-token pattern: contractions of one and of two letters after an apostrophe.
SHORT_TAILS, LONG_TAILS = ("s", "t", "m", "d"), ("re", "ve", "ll")


def class_transducer() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emission by (symbol, state), flat; symbols from RESET on first return to the fresh state."""
    step = np.zeros((2 * SYMBOLS, STATES), np.uint8)
    emit = np.zeros((2 * SYMBOLS, STATES), np.uint8)
    for symbol in range(SYMBOLS):
        for state in range(STATES):
            new, out = state, 0
            if symbol == S_INSIDE:
                pass
            elif state in (TAIL_1, TAIL_2):
                new = FRESH if state == TAIL_1 else TAIL_1
            elif symbol in (S_LETTER, S_NUMBER, S_OTHER):
                new = (IN_LETTERS, IN_NUMBERS, IN_OTHERS)[symbol]
                out = int(state not in (new, AFTER_SPACE))
            elif symbol in (S_SHORT, S_LONG):
                if state in (IN_OTHERS, AFTER_SPACE):
                    new = IN_OTHERS
                else:
                    new, out = (TAIL_1 if symbol == S_SHORT else TAIL_2), 1
            elif symbol == S_SPACE_LAST:
                new, out = AFTER_SPACE, 1
            elif symbol == S_BLANK_LAST:
                new, out = FRESH, 1
            else:
                new, out = IN_BLANKS, int(state != IN_BLANKS)
            step[symbol, state], emit[symbol, state] = new, out
        step[RESET + symbol], emit[RESET + symbol] = step[symbol, FRESH], emit[symbol, FRESH]
    return step.ravel(), emit.ravel()


def class_table(path: str) -> np.ndarray:
    """Class of every code point, as the pre-tokenizer of the vocabulary file splits it from a letter and from a digit."""
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    table = np.full(0x110000, OTHER, np.uint8)
    # Planes 0 to 3 and 14 hold all characters that have been assigned.
    maybe = np.array([c for c in (*range(0x32400), *range(0xE0000, 0xE0200)) if unicodedata.category(chr(c)) not in ("Cs", "Co")])
    for kind, mark in ((LETTER, "a"), (NUMBER, "1")):
        # "a?" stays one piece just where ? is a letter; pieces are told by where they begin.
        begins = {p[1][0] for p in split("".join(f"{mark}{chr(c)}\n" for c in maybe))}
        table[maybe[[3 * i + 1 not in begins for i in range(len(maybe))]]] = kind
    # Unicode white space
    blanks = [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    table[blanks] = BLANK
    table[0x20] = SPACE
    return table


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the characters' first bytes and their code points."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[lead].astype(np.int32)
    cp = first.copy()
    wide = np.flatnonzero(first >= 0x80)
    if len(wide):
        padded = np.append(data, np.zeros(3, np.uint8)).astype(np.int32) & 0x3F
        at, b0 = lead[wide], first[wide]
        b1, b2, b3 = padded[at + 1], padded[at + 2], padded[at + 3]
        cp[wide] = np.where(b0 < 0xE0, (b0 & 0x1F) << 6 | b1, np.where(b0 < 0xF0, (b0 & 0x0F) << 12 | b1 << 6 | b2,
                                                                       (b0 & 0x07) << 18 | b1 << 12 | b2 << 6 | b3))
    return lead, cp


def compose_scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of (chunk, state) maps by doubling."""
    reach = 1
    while reach < len(maps):
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), 1)
        reach *= 2
    return maps


class Counter:
    """Both transducers of one vocabulary file and what they have met so far."""

    def __init__(self, source: str, classes: np.ndarray):
        spec = json.loads(source)
        model = spec["model"]
        # The byte-level alphabet: printable bytes stand for themselves, the others for 256 and on, in order.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = [s.encode() for s in special]
        plain = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if t not in set(special)}
        names = list(plain)
        number = {t: i for i, t in enumerate(names)}
        self.rank, made = {}, {}
        for r, pair in enumerate(model["merges"]):
            left, right = (bytes(byte_of[c] for c in p) for p in (pair.split(" ") if isinstance(pair, str) else pair))
            self.rank[number[left] << 20 | number[right]] = r
            made.setdefault(number[left + right], (r, number[left], number[right]))
        self.made = made
        # A trie of all tokens with, for each node, the next longest suffix that is a node too.
        self.next: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        for t, i in number.items():
            node = 0
            for b in t:
                node = self.next[node].setdefault(b, len(self.next))
                if node == len(self.next):
                    self.next.append({})
                    self.ends.append(-1)
            self.ends[node] = i
        self.shorter = [0] * len(self.next)
        queue = list(self.next[0].values())
        for node in queue:
            for b, child in self.next[node].items():
                at = self.shorter[node]
                while b not in self.next[at] and at:
                    at = self.shorter[at]
                self.shorter[child] = self.next[at].get(b, 0)
                queue.append(child)
        self.step, self.emit = class_transducer()
        self.classes = classes
        self.hash_byte = salts(256, 99)
        self.hash_power = np.cumprod(np.full(1 << 16, 0xD1342543DE82EF95, np.uint64))
        self.side_by_side: dict[int, bool] = {}
        self.plans: dict[int, tuple] = {}
        self.known: dict[int, int] = {}
        self._forget_states()

    # --- tokens within a pre-token

    def _forget_states(self) -> None:
        start = (0, (-1,), (0,))
        self.ids, self.states, self.moves = {start: 0}, [start], {}
        self.side_by_side.clear()

    def _seam(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens at one edge of `token`, outermost merge first, each with the rank of the merge that absorbs it."""
        out, absorbed = [], 1 << 60
        while True:
            out.append((token, absorbed))
            if token not in self.made:
                return out
            absorbed, token = self.made[token][0], self.made[token][side]

    def _fit(self, a: int, b: int) -> bool:
        """Whether tokens a, b stay apart: no merge over the seam comes before both of its parts are absorbed. Equal ranks go
        left first."""
        if a < 0:
            return True
        got = self.side_by_side.get(a << 20 | b)
        if got is None:
            got = True
            right = self._seam(b, 1)
            for x, until_x in self._seam(a, 2):
                for y, until_y in right:
                    r = self.rank.get(x << 20 | y)
                    if r is not None and r < until_x and r <= until_y:
                        got = False
            self.side_by_side[a << 20 | b] = got
        return got

    def _plan(self, node: int, byte: int) -> tuple:
        """What reading `byte` at a trie node allows whatever the history: tokens that end, as (index of the suffix they extend,
        token); the node after; and for its suffixes the index of the suffix each extends."""
        got = self.plans.get(node << 8 | byte)
        if got is None:
            chain = [node]
            while chain[-1]:
                chain.append(self.shorter[chain[-1]])
            ending, grown = [], []
            for i, at in enumerate(chain):
                child = self.next[at].get(byte)
                if child is not None:
                    grown.append((i, child))
                    if self.ends[child] >= 0:
                        ending.append((i, self.ends[child]))
            got = self.plans[node << 8 | byte] = (tuple(ending), grown[0][1] if grown else 0, tuple(i for i, _ in grown))
        return got

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        """The transition from `state` on `byte`: (next state, tokens added)."""
        node, lasts, counts = self.states[state]
        ending, grown, origin = self._plan(node, byte)
        for i, token in ending:
            if self._fit(lasts[i], token):
                count = counts[i] + 1
                break
        else:
            raise ValueError(f"no token ends with byte {byte}")
        new = (grown, (*[lasts[i] for i in origin], token), (*[counts[i] - count for i in origin], 0))
        number = self.ids.get(new)
        if number is None:
            number = self.ids[new] = len(self.states)
            self.states.append(new)
        self.moves[state << 8 | byte] = (number, count)
        return number, count

    def tokens(self, text: bytes) -> int:
        """Tokens of one pre-token."""
        if len(self.states) > KEPT_STATES:
            self._forget_states()
        state = total = 0
        moves = self.moves
        for b in text:
            move = moves.get(state << 8 | b)
            state, added = move if move is not None else self._compile(state, b)
            total += added
        return total

    # --- pre-tokens within texts

    def _special_spans(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
        raw, spans = data.tobytes(), []
        for s in self.special:
            at = raw.find(s)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, "right")) - 1
                if at + len(s) <= offsets[row + 1]:
                    spans.append((at, at + len(s)))
                    at = raw.find(s, at + len(s))
                else:
                    at = raw.find(s, at + 1)
        return sorted(spans)

    def symbols(self, data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """What the first transducer reads at each byte; `cuts` are positions at which a piece of text begins."""
        lead, cp = code_points(data)
        kind = self.classes[cp]
        blank = kind >= BLANK
        begins = np.zeros(len(data) + 1, bool)
        begins[cuts] = True
        first = begins[lead]
        next_inside = np.zeros(len(lead), bool)
        next_inside[:-1] = ~first[1:]
        next_solid = next_inside.copy()
        next_solid[:-1] &= ~blank[1:]
        symbol = kind.copy()
        symbol[blank] = S_BLANK
        symbol[(kind == SPACE) & next_solid] = S_SPACE_LAST
        symbol[(kind == BLANK) & next_solid] = S_BLANK_LAST
        marks = np.flatnonzero((cp == 39) & next_inside)
        if len(marks):
            padded = np.append(cp, [0, 0])
            one, two = padded[marks + 1], padded[marks + 2]
            both = next_inside[marks + 1]
            symbol[marks[np.isin(one, [ord(c) for c in SHORT_TAILS])]] = S_SHORT
            for a, b in LONG_TAILS:
                symbol[marks[both & (one == ord(a)) & (two == ord(b))]] = S_LONG
        out = np.full(len(data), S_INSIDE, np.uint8)
        out[lead] = symbol + RESET * first.astype(np.uint8)
        return out

    def starts(self, symbol: np.ndarray) -> np.ndarray:
        """Positions at which a pre-token begins."""
        chunks = -(-len(symbol) // CHUNK)
        grid = np.full(chunks * CHUNK, S_INSIDE, np.uint8)
        grid[:len(symbol)] = symbol
        grid = np.ascontiguousarray(grid.reshape(chunks, CHUNK).T).astype(np.intp) * STATES
        maps = np.tile(np.arange(STATES, dtype=np.uint8), (chunks, 1))
        for row in grid:
            maps = self.step[row[:, None] + maps]
        state = np.zeros(chunks, np.intp)
        state[1:] = compose_scan(maps)[:-1, FRESH]
        marks = np.empty((CHUNK, chunks), np.uint8)
        for i, row in enumerate(grid):
            at = row + state
            marks[i] = self.emit[at]
            state = self.step[at].astype(np.intp)
        return np.flatnonzero(marks.T.ravel()[:len(symbol)])

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each row."""
        rows = len(offsets) - 1
        if not len(data):
            return np.zeros(rows, np.int64)
        spans = self._special_spans(data, offsets)
        cuts = np.unique(np.concatenate([offsets[:-1], [p for s in spans for p in s]]).astype(np.int64))
        symbol = self.symbols(data, cuts)
        for a, b in spans:
            symbol[a:b] = S_INSIDE
        starts = self.starts(symbol)
        special = np.array([a for a, _ in spans], np.int64)
        if len(special):
            starts = np.sort(np.concatenate([starts, special]))
        place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
        hashed = mix(np.add.reduceat(self.hash_byte[data] * (self.hash_power[place & 0xFFFF] + (place >> 16).astype(np.uint64) * np.uint64(2)), starts))
        unique, first, back = np.unique(hashed, return_index=True, return_inverse=True)
        ends = np.append(starts[1:], len(data))
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        known, counts = self.known, np.empty(len(unique), np.int64)
        for i, h in enumerate(unique.tolist()):
            n = known.get(h)
            if n is None:
                a, b = starts[first[i]], ends[first[i]]
                text = data[a:b].tobytes()
                n = known[h] = 1 if text in self.special else self.tokens(text)
            counts[i] = n
        total = np.append(0, np.cumsum(counts[back]))
        bounds = np.searchsorted(starts, offsets)
        return total[bounds[1:]] - total[bounds[:-1]]


_COUNTERS: dict[str, Counter] = {}


def counter(source: str, classes: np.ndarray) -> Counter:
    """The compiled vocabulary, once per Python worker."""
    if source not in _COUNTERS:
        _COUNTERS[source] = Counter(source, classes)
    return _COUNTERS[source]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`docs` with n_bytes and n_tokens; older columns of these names are replaced. `path` is a byte-level BPE file (tokenizers
    format) on the driver; its text and the class table, both of a fixed size, are broadcast."""
    spark = docs.sparkSession
    batched(spark)
    with open(path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast((f.read(), class_table(path)))
    docs = docs.drop("n_bytes", "n_tokens")
    at, names = docs.columns.index(text), [*docs.columns, "n_bytes", "n_tokens"]
    schema = widened(docs.schema, n_bytes="long", n_tokens="long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = counter(*shared.value)
        for b in batches:
            size, tokens = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            for row, data, offsets in slices(b.column(at)):
                size[row:row + len(offsets) - 1] = np.diff(offsets)
                tokens[row:row + len(offsets) - 1] = fst.count(data, offsets)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(size), pa.array(tokens)], names)

    return docs.mapInArrow(run, schema)


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs, vocabulary_path()).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))
