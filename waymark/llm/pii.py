"""Personal data replaced by surrogates that keep type, gender, script and format.

Detected entities are brought to a canonical form (letters in lower case, digits without separators; names word by word). A keyed
generator gives every canonical form a surrogate of its kind: digits for digits, letters for letters of the same case and script,
check digits where the original's held, titles' gender in the endings of names. The same form gets the same surrogate in all
documents, so references stay together, whatever separators or case an occurrence has.

Distinct forms get distinct surrogates, and none equals a form found in the input: all proposed surrogates are checked against each
other, against those already given and against the originals by joins; forms that lose a check are drawn again with the next
attempt, from the eighth on with one more character, so the loop ends. Which of several forms keeps a surrogate (the smallest)
does not depend on partitioning, so reruns with one key agree.

Texts with no entity go straight through; only the others are joined with their surrogates.

Defined results: null texts stay null, empty texts empty, both with 0 entities; overlapping detections go to the one that begins
first, then to the longer; rows that repeat are replaced alike; other columns stay as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.registry import query
from waymark.llm.textbytes import batched
from waymark.session import cut

# Titles that announce a name, by the gender they tell.
TITLES = {
    "m": ("Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Sir", "г-н", "Господин", "κ.", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Lady", "г-жа", "Госпожа", "κα", "Κυρία"),
    "n": ("Dr", "Prof", "Professor", "Doctor"),
}
GENDER = {t: g for g, names in TITLES.items() for t in names}
_CAPITAL = r"[A-ZÀ-ÖØ-ÞА-ЯЁΑ-ΩΆ-Ώ][a-zß-öø-ÿа-яёα-ωά-ώ'’-]+"
_TITLE = "|".join(sorted(map(re.escape, GENDER), key=len, reverse=True))
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: Kind, a string without which there is none (or None), pattern; the first group, if any, is the entity.
PATTERNS = [
    ("email", "@", re.compile(r"(?<![\w.+%-])[\w.+%-]++@(?:[A-Za-z0-9][A-Za-z0-9-]*\.)+[A-Za-z]{2,}", re.A)),
    ("phone", None, re.compile(r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d(?:[ .-]?\d){5,11}(?!\w)|(?<![\w(.-])(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])", re.A)),
    ("ip", ".", re.compile(rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\w)", re.A)),
    ("card", None, re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])", re.A)),
    ("ssn", "-", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", re.A)),
    ("iban", None, re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)", re.A)),
    ("keyid", None, re.compile(r"(?<!\w)(?:A[KS]IA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9]{20,})(?!\w)", re.A)),
    ("secret", None, re.compile(
        r"(?i:(?<![A-Za-z])(?:password|passwd|pwd|passphrase|token|secret|api[_-]?key|access[_-]?key)[\"']?\s*[:=]\s*[\"']?)([^\s\"',;]{6,})")),
    ("person", None, re.compile(rf"(?<!\w)(?P<title>{_TITLE})\.?\s(?P<name>{_CAPITAL}(?:\s{_CAPITAL})?)")),
]
_DIGIT = re.compile(r"\d")
_MARK = re.compile(r"[:=]")
#: Parts that stay: what tells a key's kind, a number's country, a card's issuer.
HEADS = {"keyid": re.compile(r"akia|asia|gh[pousr]_|sk-"), "card": re.compile(r"\d"), "iban": re.compile(r"[a-z]{2}")}
_SOUNDS = {  # consonants, vowels, female and male endings of names by script
    "latin": ("bdfgklmnprstv", "aeiou", ("a", "ia", "ena"), ("an", "or", "is")),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу", ("а", "ия", "ина"), ("ан", "ор", "ин")),
    "greek": ("βγδζκλμνπρστ", "αειο", ("α", "ια", "ινα"), ("ος", "ης", "ων")),
}


def luhn(digits: str) -> int:
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10


def _iban_rest(canon: str) -> int:
    return int("".join(str(int(c, 36)) for c in canon[4:] + canon[:4])) % 97


def script(word: str) -> str:
    c = ord(word[0])
    return "cyrillic" if 0x400 <= c < 0x530 else "greek" if 0x370 <= c < 0x400 else "latin"


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """(begin, end, kind, canonical form) of the entities, in order, none overlapping."""
    found = []
    digits = _DIGIT.search(text) is not None
    for kind, needs, pattern in PATTERNS:
        if needs and needs not in text or not digits and kind in ("phone", "ip", "card", "ssn", "iban") or kind == "secret" and not _MARK.search(text):
            continue
        for m in pattern.finditer(text):
            if kind == "person":
                gender = GENDER[m["title"]]
                at = m.start("name")
                parts = re.split(r"(\s)", m["name"])
                for i, word in enumerate(parts):
                    if i % 2 == 0:
                        # Of two names the first is the given one; a name alone is a family name.
                        role = f"given-{gender}" if i == 0 and len(parts) > 1 else "family"
                        found.append((at, at + len(word), f"{role}-{script(word)}", word.lower()))
                    at += len(word)
                continue
            begin, end = m.span(1) if pattern.groups else m.span()
            raw = text[begin:end]
            canon = re.sub(r"[^\d]", "", raw) if kind in ("phone", "card", "ssn") else raw.replace(" ", "").lower() if kind == "iban" else \
                raw.lower() if kind in ("email", "keyid") else raw
            if kind == "card" and not (luhn(canon) == 0 or len(canon) in (15, 16) and canon[0] in "3456"):
                continue
            if kind == "iban" and _iban_rest(canon) != 1:
                continue
            found.append((begin, end, kind, canon))
    out, reach = [], 0
    for span in sorted(found, key=lambda s: (s[0], -s[1])):
        if span[0] >= reach:
            out.append(span)
            reach = span[1]
    return out


class _Stream:
    """Numbers drawn from a key and a message."""

    def __init__(self, key: bytes, *message: str):
        self.seed = hashlib.blake2b("\0".join(message).encode(), key=key, digest_size=32).digest()
        self.pool, self.block = b"", 0

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hashlib.blake2b(self.block.to_bytes(8, "big"), key=self.seed).digest()
            self.block += 1
        value, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return value * n >> 32

    def like(self, c: str) -> str:
        if c.isascii() and c.isdigit():
            return str(self.below(10))
        if "a" <= c <= "z":
            return chr(97 + self.below(26))
        if "A" <= c <= "Z":
            return chr(65 + self.below(26))
        return c


def surrogate(key: bytes, kind: str, canon: str, attempt: int) -> str:
    """The canonical surrogate that `attempt` draws for a canonical form."""
    draw = _Stream(key, kind, canon, str(attempt))
    longer = max(0, attempt - 7)
    if kind.startswith(("given", "family")):
        hard, soft, female, male = _SOUNDS[kind.rsplit("-", 1)[1]]
        ends = female if "-f-" in kind else male if "-m-" in kind else female + male
        size = max(1, min(4, len(canon) // 3)) + longer
        return "".join(hard[draw.below(len(hard))] + soft[draw.below(len(soft))] for _ in range(size)) + hard[draw.below(len(hard))] + ends[draw.below(len(ends))]
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "email":
        local, domain = canon.rsplit("@", 1)
        host, top = domain.rsplit(".", 1)
        # One host has one surrogate, whoever writes from it.
        shared = _Stream(key, "host", host, str(attempt))
        new = "".join(shared.like(c) for c in host)
        return "".join(map(draw.like, local)) + "".join(chr(97 + draw.below(26)) for _ in range(longer)) + f"@{new}.{top}"
    if kind == "secret" and all(c in "0123456789abcdef" for c in canon):
        return "".join("0123456789abcdef"[draw.below(16)] for _ in range(len(canon) + longer))
    head = HEADS[kind].match(canon).end() if kind in HEADS else max(0, len(canon) - 10) if kind == "phone" else 0
    out = canon[:head] + "".join(map(draw.like, canon[head:])) + "".join(draw.like(canon[-1]) for _ in range(longer))
    if kind == "card" and luhn(canon) == 0:
        out = out[:-1] + str((10 - luhn(out[:-1] + "0")) % 10)
    if kind == "iban":
        out = out[:2] + "00" + out[4:]
        out = out[:2] + f"{98 - _iban_rest(out):02d}" + out[4:]
    return out


def render(kind: str, raw: str, new: str) -> str:
    """A canonical surrogate in the format of an occurrence: its separators and its case."""
    if kind in ("phone", "card", "ssn"):
        left = iter(new)
        out = "".join(next(left, "") if c.isdigit() else c for c in raw)
        return out + "".join(left)
    if kind == "iban":
        new = new.upper()
        left = iter(new)
        return "".join(c if c == " " else next(left, "") for c in raw) + "".join(left)
    if kind == "keyid":
        fixed = "".join(n.upper() if c.isupper() else n for c, n in zip(raw, new, strict=False))
        return fixed + new[len(raw):]
    if kind.startswith(("given", "family")):
        return new.upper() if raw.isupper() and len(raw) > 1 else new[0].upper() + new[1:]
    if kind == "email" and raw.upper() == raw:
        return new.upper()
    return new


def find_entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with __rid (a number for the row) and __spans: array of (begin, end, kind, canon)."""
    batched(docs.sparkSession)
    at, names = docs.columns.index(text), [*docs.columns, "__rid", "__spans"]
    span = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("canon", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 40
        for b in batches:
            spans = [[dict(zip(("begin", "end", "kind", "canon"), s, strict=True)) for s in detect(t)] if t else [] for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.arange(rid, rid + b.num_rows)), pa.array(spans, pa.list_(span))], names)
            rid += b.num_rows

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{kinds}, __rid long, __spans array<struct<begin:int,end:int,kind:string,canon:string>>")


def assign(forms: DataFrame, key: bytes) -> DataFrame:
    """(kind, canon, new) for the distinct (kind, canon) rows of `forms`; distinct within a kind and never one of the forms."""
    spark = forms.sparkSession
    own = spark.sparkContext.broadcast(key)

    def propose(attempt: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                new = [surrogate(own.value, k, c, attempt) for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(new, pa.string())], ["kind", "canon", "new"])
        return run

    forms = cut(forms.distinct())
    taken, pending, attempt = None, forms, 0
    real = forms.select("kind", F.col("canon").alias("new"))
    while True:
        drawn = cut(pending.mapInArrow(propose(attempt), "kind string, canon string, new string"))
        free = drawn.join(real, ["kind", "new"], "left_anti")
        if taken is not None:
            free = free.join(taken.select("kind", "new"), ["kind", "new"], "left_anti")
        won = cut(free.groupBy("kind", "new").agg(F.min("canon").alias("canon")).select("kind", "canon", "new"))
        taken = won if taken is None else taken.unionByName(won)
        pending = cut(drawn.join(won, ["kind", "canon"], "left_anti").select("kind", "canon"))
        if pending.isEmpty():
            return taken
        attempt += 1


def replace_entities(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """`docs` with surrogates in its texts, and n_entities; an older column of this name is replaced."""
    docs = docs.drop("n_entities")
    found = cut(find_entities(docs, text))
    some = found.filter(F.size("__spans") > 0)
    each = some.select("__rid", F.explode("__spans").alias("s")).select("__rid", "s.begin", "s.end", "s.kind", "s.canon")
    given = cut(assign(each.select("kind", "canon"), key))
    news = each.join(given, ["kind", "canon"]).groupBy("__rid").agg(F.collect_list(F.struct("begin", "end", "kind", "new")).alias("__news"))
    rows = some.drop("__spans").join(news, "__rid").drop("__rid")
    at, names = docs.columns.index(text), [*docs.columns, "n_entities"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, counts = [], []
            for t, spans in zip(b.column(at).to_pylist(), b.column(len(docs_columns)).to_pylist(), strict=True):
                parts, reach = [], 0
                for s in sorted(spans, key=lambda s: s["begin"]):
                    parts += [t[reach:s["begin"]], render(s["kind"], t[s["begin"]:s["end"]], s["new"])]
                    reach = s["end"]
                out.append("".join(parts) + t[reach:])
                counts.append(len(spans))
            columns = list(b.columns[:-1])
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int32())], names)

    docs_columns = docs.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    changed = rows.select(*docs_columns, "__news").mapInArrow(run, f"{kinds}, n_entities int")
    return found.filter(F.size("__spans") == 0).select(*docs_columns, F.lit(0).alias("n_entities")).unionByName(changed)


@query("op9_pii_surrogates")
def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return replace_entities(docs, b"surrogates of the registered query").select("doc_id", "n_entities", "text")
