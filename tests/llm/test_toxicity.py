import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from namelens.llm.toxicity import (
    BEGIN,
    DISCOUNT,
    END,
    ORDER,
    SHARED_DISCOUNT,
    class_models,
    count_grams,
    counted_sample,
    features,
    fit_model,
    fit_sample,
    fold,
    logistic_fit,
    score,
    shared_model,
)

LABELS = "doc_id bigint, quality int, toxic int"


def grams_of(word, order):
    marked = BEGIN + word + END
    return [marked[max(0, k - order + 1) : k + 1] for k in range(1, len(marked))]


def corpus(n, seed=1):
    """Ordinary words; toxic documents also have some of two stems with random endings."""
    rng = random.Random(seed)
    stems = ["ab", "cor", "den", "fil", "gar", "hom", "jun", "lat", "mor", "nel"]
    word = lambda: "".join(rng.choice(stems) for _ in range(rng.randrange(1, 4)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(5, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(1 + len(words) // 15):
                words[rng.randrange(len(words))] = rng.choice(["zork", "quav"]) + word()
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


TEXTS = [("abba cab abba abba", 1), ("abc abc bca abc abd", 0), ("cabba dabc", None), ("bab abba", 1)]


def counted(docs, order):
    own = docs([(i, t) for i, (t, _) in enumerate(TEXTS)]).select("doc_id", "text")
    label = F.when(F.col("doc_id").isin(0, 3), 1).when(F.col("doc_id") == 1, 0)
    return count_grams(own.withColumn("_class", label.cast("int")), order)


class Plain:
    """Both models from their definition."""

    def __init__(self, order):
        self.by, every = {0: Counter(), 1: Counter()}, set()
        for text, kind in TEXTS:
            for w in text.split():
                grams = grams_of(w, order)
                every |= {g[i:] for g in grams for i in range(len(g))}
                if kind is not None:
                    self.by[kind].update(grams)
        self.before = Counter(t[1:] for t in every if len(t) > 1)
        self.letters = {g for g in self.before if len(g) == 1}
        least = min(sum(n.values()) for n in self.by.values())
        self.scale = {k: least / sum(n.values()) for k, n in self.by.items()}

    def shared(self, history, letter):
        if history is None:
            return 1 / len(self.letters)
        counts = {g: n for g, n in self.before.items() if g[:-1] == history}
        below = self.shared(history[1:] if history else None, letter)
        if not counts:
            return below
        n, off = counts.get(history + letter, 0), SHARED_DISCOUNT
        return (n - min(n, off) + sum(min(c, off) for c in counts.values()) * below) / sum(counts.values())

    def p(self, kind, history, letter):
        counts = {g: n * self.scale[kind] for g, n in self.by[kind].items() if g[:-1] == history}
        below = self.shared(history[1:], letter)
        if not counts:
            return below
        n, off = counts.get(history + letter, 0), DISCOUNT
        return (n - min(n, off) + sum(min(c, off) for c in counts.values()) * below) / sum(counts.values())


@pytest.mark.parametrize("order", [3, ORDER])
def test_model_is_kneser_ney(docs, order):
    plain = Plain(order)
    model = fit_model(counted(docs, order), order)
    # Also words with n-grams, histories and letters of one class or none.
    for word in ("abba", "abc", "bab", "cab", "dabc", "abcabd", "dd", "ccc", "a", "bd"):
        want = sum(math.log(plain.p(1, g[:-1], g[-1]) / plain.p(0, g[:-1], g[-1])) for g in grams_of(word, order))
        assert model.word_ratios([word])[0] == pytest.approx(want, abs=1e-5)
    assert any(abs(model.word_ratios([w])[0]) > 0.01 for w in ("dd", "ccc"))
    # The letters of another alphabet come after histories of neither class, but for the first.
    assert model.word_ratios(["жук"])[0] == pytest.approx(float(model.word_ratios(["ж"])[0]), abs=0.5)


def test_probabilities_of_each_history_sum_to_one(docs):
    plain = Plain(ORDER)
    counts = counted(docs, ORDER)
    shared = {r.gram: r.p for r in shared_model(counts).collect()}
    assert set(shared) == set(plain.before)
    for gram, p in shared.items():
        assert p == pytest.approx(plain.shared(gram[:-1], gram[-1]))
    grams, histories = class_models(counts)
    seen = {r.gram: (r.p_ordinary, r.p_toxic) for r in grams.collect()}
    for r in histories.collect():
        for kind, held in enumerate((r.held_ordinary, r.held_toxic)):
            assert 0 < held <= 1
            total = sum(
                seen[r.history + c][kind] if r.history + c in seen else held * plain.shared(r.history[1:], c)
                for c in plain.letters
            )
            assert total == pytest.approx(1)


def test_sample_is_halved_until_its_grams_fit(docs, rows):
    texts, labels = corpus(200)
    frame, marks = docs(texts), rows(labels, LABELS)
    whole, _, counts = counted_sample(frame, marks, 64)
    n = counts.where("n_toxic + n_ordinary > 0").count()
    part, _, fewer = counted_sample(frame, marks, 64, n - 1)
    assert part.count() < whole.count() and fewer.where("n_toxic + n_ordinary > 0").count() < n
    # What all documents hold is counted in any case.
    assert counts.agg(F.sum("n_all")).first() == fewer.agg(F.sum("n_all")).first()


def test_held_out_accuracy(docs, rows):
    texts, labels = corpus(500)
    found = score(docs(texts), rows(labels, LABELS)).withColumn("held_out", fold(F.col("doc_id")) == 0)
    toxic = {i: t for i, _, t in labels}
    held = [(toxic[r.doc_id], r.toxic_score) for r in found.where("held_out").collect()]
    right = sum((s >= 0.5) == (t == 1) for t, s in held)
    assert len(held) > 60 and right / len(held) > 0.95
    assert all(0 <= s <= 1 for _, s in held)


def test_labels_of_held_out_rows_are_not_used(docs, rows):
    texts, labels = corpus(120, 2)
    frame = docs(texts)
    held = {r.doc_id for r in frame.where(fold(F.col("doc_id")) == 0).collect()}
    turned = [(i, q, 1 - t if i in held else t) for i, q, t in labels]
    one = {r.doc_id: r.toxic_score for r in score(frame, rows(labels, LABELS)).collect()}
    other = {r.doc_id: r.toxic_score for r in score(frame, rows(turned, LABELS)).collect()}
    assert one == other


def test_sample_is_bounded_and_weighted(rows):
    labels = [(i, 0, int(i % 3 == 0)) for i in range(300)] + [(1, 0, 1), (None, 0, 1), (2, 0, None), (4, 0, 7)]
    found = defaultdict(list)
    for r in fit_sample(rows(labels, LABELS), 20).collect():
        found[r.toxic].append(r)
    assert len(found[0]) == len(found[1]) == 20
    assert not any(r.doc_id == 1 for r in found[0] + found[1])
    assert sum(r.weight for r in found[0]) > 100


def test_awkward_rows(awkward, nothing, rows):
    labels = rows([(1, 0, 1), (2, 0, 0), (3, 0, 1), (6, 0, 0), (99, 1, 1)], LABELS)
    found = score(awkward, labels)
    assert found.columns == [*awkward.columns, "toxic_score"]
    got = found.collect()
    assert len(got) == awkward.count() and all(0 <= r.toxic_score <= 1 for r in got)
    by_text = defaultdict(set)
    for r in got:
        by_text[(r.text or "").strip()].add(r.toxic_score)
    assert all(len(s) == 1 for s in by_text.values())
    assert score(nothing, labels).collect() == []
    assert all(r.toxic_score < 1e-5 for r in score(awkward, labels.limit(0)).collect())


def test_logistic_fit_and_features():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 2))
    y = rng.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] - 0.5)))
    fitted = logistic_fit(x, y.astype(float), np.ones(4000))
    assert np.allclose(fitted, [2, -1, -0.5], atol=0.25)
    assert features(np.zeros(0)) == features(np.zeros(1))


def test_grams_are_counted_like_a_plain_loop(docs, monkeypatch):
    monkeypatch.setattr("namelens.llm.toxicity.GRAM_BYTES", 40)
    texts = [row for row in corpus(30)[0]] + [(98, "é🙂é"), (99, None)]
    rows = docs(texts).withColumn("_class", F.when(F.col("doc_id") < 20, F.col("doc_id").cast("int") % 2))
    want = defaultdict(lambda: [0, 0, 0])
    for i, text in texts:
        for gram in [g for w in (text or "").split() for g in grams_of(w, ORDER)]:
            want[gram][0] += 1
            if i < 20:
                want[gram][2 - i % 2] += 1
    assert {r.gram: [r.n_all, r.n_toxic, r.n_ordinary] for r in count_grams(rows).collect()} == want
