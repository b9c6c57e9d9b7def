"""Fill-in-middle, quality rules and the prefix trie against plain versions, with odd input."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.llm import fill_middle, prefix_trie, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LINE = re.compile(r"[^\n]*\n|[^\n]+")
LONG = "\n".join(f"line {i} of a long text, number {i * i}" for i in range(8000))
TEXTS = [
    (1, "one line"), (2, "a\nb\nc\n"), (3, None), (4, ""), (5, "\n\n\n"), (6, LONG), (7, "x <P> y\nz"), (8, "<\nP>\n<S"), (None, "null id\nhere\n"),
    (None, None), (10, "twice\nthe same"), (10, "twice\nthe same"), (10, "another\n"), (11, "日本\n語 🙂\r\nмир\n"), (12, "x" * 300_000), (13, "<M"), (14, "P>\n<\n"),
    (15, " "), (16, "!!! WOW!! " * 30), (17, "go " * 50), (18, "a b c d e f g h " * 9), (19, "same line here\n" * 40), (20, "# $ % & | < >\n" * 5),
    (21, "tail words repeat a b c d e f g h and a b c d e f g h i " + " ".join(f"w{i}" for i in range(40))), (22, " a\na \na\n a\n\n"), (23, "Ab ab AB ab ab"),
]
CLASH = ("n", "form", "fim_text", "Pieces", "restored", "kept", "rejected_by", "n_words", "rules_run", "key", "depth", "bits", "took")


@pytest.fixture(scope="module", params=["rows", "empty"])
def docs(request, spark):
    df = spark.createDataFrame(TEXTS if request.param == "rows" else [], "doc_id long, text string")
    return df.withColumns({c: F.lit("x") for c in CLASH})


def as_rows(df):
    return [r.asDict() for r in df.collect()]


def plain_fill(doc_id, text, seed=7, share=100, spm=50):
    text = text or ""
    units = LINE.findall(text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or c % 100 >= share:
        return len(units), "plain", None, None, text
    low, high = sorted((a % (len(units) + 1), b % (len(units) + 1)))
    p, m, s = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
    if d % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("share, spm", [(100, 50), (60, 0), (0, 50), (100, 100)])
def test_fill_middle_matches_slicing_and_comes_back(docs, share, spm):
    got = as_rows(fill_middle.restore(fill_middle.fill_middle(docs, share=share, spm=spm)))
    assert len(got) == docs.count()
    for r in got:
        n, form, prefix, middle, out = plain_fill(r["doc_id"], r["text"], 7, share, spm)
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["fim_text"]) == (n, form, prefix, middle, out)
        assert r["restored"] == (r["text"] or "") and r["key"] == "x"
        buffers = ((r["text"] or "").encode(), fill_middle.MARKS)
        assert b"".join(buffers[p["buffer"]][p["start"]:p["start"] + p["length"]] for p in r["pieces"]).decode() == out


def test_fill_digests_hash_outputs_and_texts(docs):
    want = Counter()
    for r in as_rows(docs):
        n, form, prefix, middle, out = plain_fill(r["doc_id"], r["text"])
        want[(r["doc_id"], n, form, prefix, middle, *(hashlib.sha256(t.encode()).hexdigest() for t in (out, r["text"] or "")))] += 1
    assert Counter(tuple(r) for r in fill_middle.fill_digests(docs).collect()) == want


def test_pieces_split_anywhere():
    text = b"hello world"
    pieces = [(0, 0, 5), (1, 3, 3), (0, 5, 6)]
    whole = b"".join(fill_middle.read(pieces, text))
    for at in range(len(whole) + 1):
        left, right = fill_middle.split(pieces, at)
        assert b"".join(fill_middle.read(left, text)) == whole[:at] and b"".join(fill_middle.read(right, text)) == whole[at:]
        assert all(length for _, _, length in left + right)


def plain_counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen = defaultdict(list)
    for i in range(len(w) - 7):
        seen[tuple(w[i:i + 8])].append(i)
    covered = {j for places in seen.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(lines) - len(set(lines)),
            "n_repeat_words": len(covered), "n_lines": len(lines), "n_upper": sum("A" <= c <= "Z" for c in text), "n_bangs": text.count("!"),
            "n_letters": sum(c.isascii() and c.isalpha() for c in text), "n_echoes": sum(a == b for a, b in zip(w, w[1:], strict=False))}


def plain_rejections(c):
    return {name for name, gone in {
        "short": c["n_words"] < 20, "repetitive": 100 * c["n_repeat_words"] > 30 * c["n_words"], "symbols": 10 * c["n_symbols"] > c["n_words"],
        "word length": not 2 * c["n_words"] <= c["word_chars"] <= 20 * c["n_words"], "repeated lines": 100 * c["n_dup_lines"] > 50 * c["n_lines"],
        "echoes": 100 * c["n_echoes"] > 30 * c["n_words"], "shouting": 2 * c["n_upper"] > c["n_letters"], "exclaiming": 10 * c["n_bangs"] > c["n_words"]}.items() if gone}


def test_quality_rules_judge_alike_in_any_order(docs):
    rules = quality_rules.plan(docs, sample=docs)
    assert sorted(r.name for r in rules) == sorted(r.name for r in quality_rules.RULES)
    for order in (rules, quality_rules.RULES, quality_rules.RULES[::-1]):
        got = as_rows(quality_rules.apply_rules(docs, order, features=quality_rules.BASE))
        assert len(got) == docs.count()
        for r in got:
            counts = plain_counts(r["text"])
            gone = plain_rejections(counts)
            first = next((i for i, rule in enumerate(order) if rule.name in gone), None)
            assert {f: r[f] for f in quality_rules.BASE} == {f: counts[f] for f in quality_rules.BASE}
            assert (r["kept"], r["rejected_by"]) == (first is None, None if first is None else order[first].name)
            assert r["rules_run"] == (len(order) if first is None else first + 1) and r["form"] == "x"


def test_quality_features_over_many_short_texts():
    rng = np.random.default_rng(4)
    texts = ["".join(rng.choice(list("ab \n!A#"), rng.integers(0, 120))) for _ in range(400)]
    texts += [" ".join(rng.choice(["u", "v"], 60)) for _ in range(40)]
    body = "".join(texts).encode()
    held = quality_rules.Texts(np.frombuffer(body, np.uint8), np.append(0, np.cumsum([len(t) for t in texts])))
    for feature in plain_counts(""):
        assert getattr(held, feature)().tolist() == [plain_counts(t)[feature] for t in texts], feature


def test_rules_with_much_rejection_for_little_time_come_first():
    rules = tuple(quality_rules.Rule(name, (f,), lambda c: c) for name, f in (("dear", "x"), ("cheap", "y"), ("rare", "z"), ("same", "y")))
    # Patterns as bits: dear and cheap reject the same documents, rare rejects others, "same" needs a feature that is paid for.
    order = quality_rules.ordered(rules, {"x": 5.0, "y": 1.0, "z": 1.0}, Counter({0b0011: 50, 0b0100: 10, 0b1000: 2, 0: 100}))
    assert [r.name for r in order] == ["cheap", "same", "rare", "dear"]


def plain_trie(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(v, key=lambda x: x[0])] for c, v in turns.items()}
    full = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        full[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, path in full.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    out = set()
    for path, held in members.items():
        below = [q for q in members if q[:len(path)] == path]
        kids = {q: sum(len(p) == len(q) + 1 and p[:len(q)] == q for p in below) for q in below}
        ends = sorted(c for c in held if len(full[c]) == len(path))
        out.add((min(held), len(path), min(members[path[:-1]]) if path else None, len(held), kids[path], sum(k == 0 for k in kids.values()),
                 sum((len(members[q]) - 1) * (len(WORD.findall(q[-1][1])) if q else 0) for q in below), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def conversations(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for c in [*range(-25, 70), 400, 401, 425, 10**15]:
        for turn in range(rng.integers(1, 9)):
            rows.append((c, None if turn == 0 and c % 3 == 0 else turn, ("user", "assistant", None)[rng.integers(0, 3)], ("a b", "a  b", "c", "", None, "long text of words")[rng.integers(0, 6)]))
    rows += [(5, 100 + i, "user", "again and again") for i in range(40)] + [(c, t, "user", "hot") for c in range(80, 120) for t in range(6)]
    return rows + [(c, t, "user", "hot") for c in range(120, 140) for t in range(9)] + [(None, 1, "user", "lost"), (None, None, None, None)]


@pytest.mark.parametrize("block, local, ids", [(4096, 20_000, 4096), (3, 4, 2), (2, 1, 7)])
def test_prefix_trie_matches_plain_nodes(spark, block, local, ids):
    rows = conversations(block)
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("x") for c in (*CLASH, "rank", "a", "parent")})
    got = prefix_trie.prefix_trie(given.repartition(7, "text"), block, local, ids).collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == plain_trie(rows)


def test_prefix_trie_of_nothing_of_equal_turns_and_of_copies(spark):
    kinds = "conv_id long, turn long, role string, text string"
    assert prefix_trie.prefix_trie(spark.createDataFrame([], kinds)).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "u", "t")], kinds)).count() == 0
    same = [(20, 1, "u", "w w")] * 30
    got = sorted(prefix_trie.prefix_trie(spark.createDataFrame(same, kinds), 4, 5, 2).collect(), key=lambda r: r["depth"])
    assert [r["depth"] for r in got] == list(range(31)) and {r["n_leaves"] for r in got} == {1} and {r["saved_tokens"] for r in got} == {0}
    # Ties: turns of one number come in a fixed order whatever the order of the rows.
    ties = [(40, 1, "u", t) for t in "abcdef"]
    one, two = (sorted(map(tuple, prefix_trie.prefix_trie(spark.createDataFrame(x, kinds)).collect()), key=str) for x in (ties, ties[::-1]))
    assert one == two


def test_centroid_rounds_grow_with_the_logarithm_of_a_path():
    for n in (1, 2, 100, 5000):
        parent, depth = np.arange(n) - 1, np.arange(n)
        leaves, tokens, rounds = prefix_trie.split_all(parent, depth, n - depth, (depth == n - 1).astype(np.int64), np.ones(n, np.int64))
        assert leaves.tolist() == [1] * n and tokens.tolist() == (n - depth).tolist() and rounds <= n.bit_length()


def test_centroids_of_random_forests():
    rng = np.random.default_rng(8)
    for n in (1, 3, 40, 900):
        order = rng.permutation(n)
        parent, depth = np.full(n, -1), np.zeros(n, np.int64)
        for i in range(1, n):
            if rng.random() > 0.05:
                parent[order[i]] = order[rng.integers(max(0, i - 9), i)]
                depth[order[i]] = depth[parent[order[i]]] + 1
        leaf, saved = rng.integers(0, 2, n), rng.integers(0, 50, n)
        want = [np.array(x, np.int64) for x in (leaf, saved, rng.integers(1, 4, n))]
        for v in order[::-1]:
            if parent[v] >= 0:
                for w in want:
                    w[parent[v]] += w[v]
        leaves, tokens, _ = prefix_trie.split_all(parent, depth, want[2], leaf, saved)
        assert (leaves == want[0]).all() and (tokens == want[1]).all()
