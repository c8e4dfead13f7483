import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from namelens.llm import language_model
from namelens.llm.language_model import (
    END,
    NOISE,
    Parameters,
    Tables,
    contexts,
    held_out,
    nce_step,
    noise_shares,
    op12_language_model,
    score_texts,
)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def base_scores(rows):
    """(held_out, n_tokens, n_known, N, base score) of (doc_id, text) rows."""
    counts = Counter()
    for doc_id, text in rows:
        if not is_held_out(doc_id):
            counts.update([*tokens(text), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc_id, text in rows:
        own = [*tokens(text), None]
        score = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        out.append((is_held_out(doc_id), len(own), sum(counts[t] > 0 for t in own), n, score))
    return out, counts


def model_score(text, model, counts):
    """The log10 probability by the definition: all units' scores, one context after the other."""
    units, p = model.units, model.parameters
    own = {w: u for w, u in zip(units.hashes.tolist(), units.word_units.tolist())}
    masses = Counter()
    kinds = {}
    for word, c in counts.items():
        if word is not None:
            kinds[word] = own.get(int(language_model.words_of([word.encode()]).hashes[0]), None)
            if kinds[word] is None:
                kinds[word] = units.of_word(word)
            masses[kinds[word]] += c + 0.5
    total, before = 0.0, [END, END]
    for word in [*tokens(text), None]:
        unit = END if word is None else kinds.get(word, None)
        if unit is None:
            unit = units.of_word(word)
        context = p.read[before[1]] @ p.near + p.read[before[0]] @ p.far
        scores = p.said @ context + p.bias
        total += (scores[unit] - np.log(np.exp(scores).sum())) / math.log(10)
        if units.masses[unit] != 0:
            total += math.log10((counts[word] + 0.5) / (masses[unit] + 0.5))
        before = [before[1], unit]
    return total


def corpus(seed, n):
    rng = random.Random(seed)
    common = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        words = []
        while rng.random() < 0.97 and len(words) < 200:
            words.append(rng.choice(common[:20]))
            # The next word follows from this one.
            words.append(common[20 + int(words[-1][1:]) % 20])
            if rng.random() < 0.1:
                words.append(rng.choice(["É", "日本", "x\x85y"]) + str(rng.randrange(200)))
        rows.append((i, " ".join(words).title() if i % 7 == 0 else "\n".join(words)))
    return rows


def in_order(df):
    return [tuple(r) for r in df.orderBy("doc_id", "n_tokens").collect()]


@pytest.fixture
def few_units(monkeypatch):
    """So few that small texts have words of every kind."""
    monkeypatch.setattr(language_model, "OWN_WORDS", 12)
    monkeypatch.setattr(language_model, "ENDINGS", 5)
    monkeypatch.setattr(language_model, "SENT_WORDS", 40)


def test_like_brute_force(spark, few_units):
    rows = corpus(1, 150) + [(1000, None), (1001, ""), (1002, "unknown words only here")]
    rows += [(2000 + i, rows[3][1]) for i in range(75)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    out, model = score_texts(docs)
    expected, counts = base_scores(rows)
    assert model.units.size == 1 + 12 + 5 + 1 and 0 < len(model.units.hashes) <= 40
    found = {r["doc_id"]: r for r in out.collect()}
    assert len(found) == len(rows)
    for (doc_id, text), (_, n, known, total, base) in zip(rows, expected):
        r = found[doc_id]
        assert (r["n_tokens"], r["n_known"], model.units.tokens) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-12)
        assert r["score"] == pytest.approx(model_score(text, model, counts), rel=1e-9)


def test_probabilities_sum_to_one(spark, few_units):
    docs = spark.createDataFrame(corpus(2, 60), "doc_id bigint, text string")
    _, model = score_texts(docs)
    size = model.units.size
    word = np.tile(np.arange(size), size)
    for two in range(size):
        logs = model.tables.log_probabilities(word, np.repeat(np.arange(size), size), np.full(size * size, two))
        assert np.allclose(np.exp(logs).reshape(size, size).sum(axis=1), 1, atol=1e-12)


def test_learns_what_follows(spark):
    """Held-out texts become likelier than by counts alone."""
    docs = spark.createDataFrame(corpus(3, 3000), "doc_id bigint, text string")
    out, _ = score_texts(docs)
    sums = out.where(held_out(F.col("doc_id"))).agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert sums[0] > sums[1] + 0.2 * sums[2]


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(4)
    counts = rng.integers(1, 50, 9)
    p = Parameters.start(counts, 3)
    word, one, two, drawn = (rng.integers(0, 9, n) for n in (20, 20, 20, 6))
    noise = np.log(NOISE * noise_shares(counts))

    def loss(flat):
        q = p.like(flat)
        context = q.read[one] @ q.near + q.read[two] @ q.far
        true = (context * q.said[word]).sum(axis=1) + q.bias[word] - noise[word]
        false = context @ q.said[drawn].T + (q.bias - noise)[drawn]
        return (np.log1p(np.exp(-true)).sum() + np.log1p(np.exp(false)).sum()) / len(word)

    flat, gradient = p.flat(), nce_step(p, word, one, two, drawn, noise).flat()
    for i in range(len(flat)):
        step = np.zeros(len(flat))
        step[i] = 1e-6
        assert gradient[i] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-6, abs=1e-6)


@pytest.mark.parametrize("scale", [1, 8, 60])
def test_sums_over_units_are_one_product(scale):
    p = Parameters.start(np.arange(1, 8), 4)
    tables = Tables.of(p.like(p.flat() * scale))
    for one in range(7):
        for two in range(7):
            both = tables.near[one] + tables.far[two]
            expected = both.max() + np.log(np.exp(both - both.max()).sum())
            assert tables.sums[one, two] == pytest.approx(expected, rel=1e-10, abs=1e-10)


def test_contexts_end_with_their_text():
    import pyarrow as pa

    texts = [np.array(t, dtype="<u2").tobytes() for t in ([5, 6, 7, 0], [0], [8, 9, 0])]
    word, one, two, starts = contexts(pa.array(texts))
    assert word.tolist() == [5, 6, 7, 0, 0, 8, 9, 0]
    assert one.tolist() == [0, 5, 6, 7, 0, 0, 8, 9]
    assert two.tolist() == [0, 0, 5, 6, 0, 0, 0, 8] and starts.tolist() == [0, 4, 5]


def test_awkward_rows(awkward):
    out, _ = score_texts(awkward)
    assert out.columns == [*[c for c in awkward.columns if c != "text"], "n_tokens", "n_known", "base_score", "score"]
    texts = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    expected, _ = base_scores(texts)
    found = sorted((r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in out.collect())
    assert found == sorted((n, known, round(base, 6)) for _, n, known, _, base in expected)


def test_clashing_columns(spark):
    ddl = "doc_id bigint, text string, n int, units string, `a.b` int, score string, _id int, rare int, word string, _training int"
    docs = spark.createDataFrame([(1, "a b", 1, "u", 2, "old", 3, 4, "w", 5)] * 2, ddl)
    out, _ = score_texts(docs)
    assert out.columns == ["doc_id", "n", "units", "a.b", "_id", "rare", "word", "_training", "n_tokens", "n_known", "base_score", "score"]
    assert [tuple(r)[:8] for r in out.collect()] == [(1, 1, "u", 2, 3, 4, "w", 5)] * 2


def test_nothing_to_learn_from(spark, nothing):
    assert score_texts(nothing)[0].collect() == []
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    rows = score_texts(docs, training=F.lit(False))[0].orderBy("doc_id").collect()
    assert [(r["n_tokens"], r["n_known"], r["base_score"]) for r in rows] == [(3, 0, 0.0), (1, 0, 0.0)]


def test_query(spark, tmp_path):
    rows = corpus(5, 80) + [(None, "no id"), (7, "again"), (7, "again")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    expected, _ = base_scores(rows)
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    wanted = sorted(((doc_id, *own) for (doc_id, _), own in zip(rows, expected)), key=key)
    found = sorted((tuple(r) for r in op12_language_model(spark, str(tmp_path)).collect()), key=key)
    assert [r[:5] for r in found] == [r[:5] for r in wanted]
    assert [r[5] for r in found] == pytest.approx([r[5] for r in wanted], rel=1e-12)
