import random
import re
from collections import Counter

import numpy as np
import pytest

from namelens.llm.automata import CountAutomaton, united
from namelens.llm.counting import sort_rows
from namelens.llm.phrases import collocations, part_counts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, least, longest=5, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) from all phrases of (text, lang) rows."""
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        own = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in f.items():
        frequent = {p: c for p, c in own.items() if c >= least}
        found = []
        for p, a in frequent.items():
            if len(p) == 1:
                continue
            inside = any(
                len(q) > len(p) and c >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, c in frequent.items()
            )
            if inside:
                continue
            cuts = [(1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def shard(rng, depth, words):
    rows = [[rng.randrange(1, words) for _ in range(rng.randrange(1, depth + 1))] for _ in range(rng.randrange(0, 80))]
    return rows


def filled(rows, depth):
    out = np.zeros((len(rows), depth), dtype=np.uint64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


@pytest.mark.parametrize("seed", range(40))
def test_automata_like_a_counter(seed):
    rng = random.Random(seed)
    depth = rng.choice([1, 2, 3, 5])
    shards = [shard(rng, depth, 3 + seed % 6) for _ in range(3)]
    built = [
        CountAutomaton.from_sorted(*sort_rows(filled(s, depth), np.ones(len(s), dtype=np.int64))) for s in shards
    ]
    both = united([CountAutomaton.from_bytes(a.to_bytes()) for a in built], depth)
    counts = Counter(tuple(r[:k]) for s in shards for r in s for k in range(1, len(r) + 1))
    asked = [*counts, *[tuple(rng.randrange(1, 10) for _ in range(rng.randrange(1, depth + 2))) for _ in range(60)]]
    assert both.lookup(filled(asked, depth + 1)).tolist() == [counts[q] for q in asked]
    found = {tuple(r): c for rows, own in both.frequent(2, 1) for r, c in zip(rows.tolist(), own.tolist())}
    assert found == {p: c for p, c in counts.items() if c >= 2}


def test_equal_continuations_are_one_state():
    rows = np.array([[w, 7, 8] for w in range(1, 1001)], dtype=np.uint64)
    automaton = CountAutomaton.from_sorted(rows, np.ones(1000, dtype=np.int64))
    assert [len(v) for v in automaton.labels] == [1000, 1, 1]
    assert sorted(map(tuple, automaton.phrases()[0].tolist())) == sorted(map(tuple, rows.tolist()))


def test_own_counts_instead_of_sums():
    rows = np.array([[1, 0], [1, 2], [3, 4]], dtype=np.uint64)
    automaton = CountAutomaton.from_sorted(rows, np.array([9, 5, 6]), summed=False)
    assert automaton.lookup(np.array([[1, 0], [1, 2], [3, 0], [3, 4], [1, 4], [0, 0]], dtype=np.uint64)).tolist() == [9, 5, 0, 6, 0, 0]


def corpus(seed, docs):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["É", "日本", "a\x85b", "New", "york"]
    stock = ["New York city hall", "in the middle of the", "w1 w1 w1 w1 w1 w1", "a b c d e f g"]
    rows = []
    for i in range(docs):
        parts = []
        for _ in range(rng.randrange(0, 14)):
            parts.append(rng.choice(stock) if rng.random() < 0.4 else rng.choice(words))
            if rng.random() < 0.2:
                parts.append(rng.choice([".", ",", "\n", "\x0b", "  ", "\t", "!?"]))
        rows.append((" ".join(parts), rng.choice(["en", "en", "de", None, ""])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(spark, seed):
    rows = corpus(seed, 300) + [(None, "en"), ("", None), ("one", "xx")]
    # Copies of one text are a third of all rows.
    rows += [("the hot passage of this corpus, The Hot Passage", "en")] * 150
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    found = sorted(map(tuple, collocations(docs, least=8).collect()))
    assert found == brute_force(rows, 8) and len(found) > 20


def test_first_ones_only(spark):
    rows = corpus(3, 200)
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(map(tuple, collocations(docs, least=3, top=5).collect())) == brute_force(rows, 3, top=5)


def test_very_long_text(spark):
    text = "x y z " * 30_000 + "\n" + "word" * 50_000
    docs = spark.createDataFrame([(text, "en"), ("x y", "de")], "text string, lang string")
    assert sorted(map(tuple, collocations(docs).collect())) == brute_force([(text, "en"), ("x y", "de")], 100)


def test_awkward_rows_and_clashing_columns(spark, awkward):
    assert [f for f in collocations(awkward, least=2).collect() if f["phrase"] == "alpha beta gamma delta epsilon"]
    clash = "text string, lang string, label int, n int, word int, labels int, range int, `a.b` int"
    docs = spark.createDataFrame([("p q p q p q", None, 1, 2, 3, 4, 5, 6)], clash)
    assert sorted(map(tuple, collocations(docs, least=2).collect())) == brute_force([("p q p q p q", None)], 2)


def test_empty_table(nothing):
    out = collocations(nothing)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and out.collect() == []


def test_large_products(spark):
    """Counts whose products pass 64 bits: parts are read by the automata, the arithmetic is decimal."""
    rows = [(1, [5], 3 * 10**12), (1, [-6], 10**12), (2, [5, -6], 9 * 10**11)]
    phrases = spark.createDataFrame(rows, "size int, labels array<bigint>, a bigint")
    assert part_counts(phrases).collect()[0].asDict() == {"labels": [5, -6], "k": 1, "l": 3 * 10**12, "r": 10**12}
    cut = phrases.selectExpr(
        "((1000 * cast(900000000000 as decimal(18,0))) * cast(40000000000000 as decimal(18,0)))"
        " div (cast(3000000000000 as decimal(18,0)) * cast(1000000000000 as decimal(18,0))) as score"
    )
    assert cut.first()["score"] == 1000 * 900000000000 * 40000000000000 // (3 * 10**24)
