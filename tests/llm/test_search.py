import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from namelens.llm import search as module
from namelens.llm.search import Shard, build_index, search


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_force(rows, queries, top):
    bags = [(i, Counter(words(t))) for i, t in rows]
    bags = [(i, c) for i, c in bags if c]
    df = Counter(w for _, c in bags for w in c)
    n, mean = len(bags), sum(sum(c.values()) for _, c in bags) / len(bags)
    out = {}
    for q, text in queries:
        scores = []
        for i, c in bags:
            long = 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)
            s = sum(
                math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + long)
                for w in set(words(text))
                if w in c
            )
            if s > 0:
                scores.append((-round(s, 6), i is None, i or 0))
        out[q] = sorted(scores)[:top]
    return out


def found(index, queries, top):
    got = {}
    for r in search(index, queries, top).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-r.score, r.doc_id is None, r.doc_id or 0))
    return got


def same(got, want):
    assert {q: [x[1:] for x in hits] for q, hits in got.items()} == {
        q: [x[1:] for x in hits] for q, hits in want.items() if hits
    }
    assert all(a[0] == pytest.approx(b[0], abs=3e-6) for q in got for a, b in zip(got[q], want[q]))


@pytest.mark.parametrize("settings", [{}, {"SHARD_WORDS": 300, "BLOCK_TERMS": 60, "QUERIES_AT_ONCE": 3, "BLOCK_DOCS": 4}])
def test_like_brute_force(docs, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(module, name, value)
    rng = random.Random(5)
    word = lambda: f"w{int(rng.paretovariate(0.7)) % 400}"
    rows = [(i, " ".join(word() for _ in range(rng.randrange(1, 60)))) for i in range(150)]
    rows += [(500 + i, rows[i][1]) for i in range(5)]
    frame = docs(rows)
    queries = frame.where("doc_id % 10 = 0").select(F.col("doc_id").alias("query_id"), "text")
    want = brute_force(rows, [r for r in rows if r[0] % 10 == 0], 7)
    same(found(build_index(frame), queries, 7), want)


def test_awkward_rows(awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    queries = awkward.select(F.col("doc_id").alias("query_id"), "text").where("query_id in (1, 3, 4, 5, 6, 8)")
    want = brute_force(rows, [r for r in dict(rows).items() if r[0] in (1, 3, 4, 5, 6, 8)], 3)
    same(found(build_index(awkward), queries, 3), want)
    assert search(build_index(nothing), queries).collect() == []
    assert search(build_index(awkward), queries.limit(0)).collect() == []


def shard_of(rng, documents, terms):
    """A shard of random documents, and its counts as a matrix."""
    tfs = rng.poisson(4 / np.arange(1, terms + 1) ** 0.7, (documents, terms))
    tfs[:, 0] += tfs.sum(axis=1) == 0
    tfs[documents // 2] = tfs[0]
    own, docs = np.nonzero(tfs.T)
    row = {
        "ids": [int(i) for i in rng.permutation(documents)],
        "lengths": tfs.sum(axis=1).astype(np.int64).tobytes(),
        "terms": (np.unique(own) * 3).astype(np.uint64).tobytes(),
        "counts": np.unique(own, return_counts=True)[1].astype(np.int32).tobytes(),
        "docs": docs.astype(np.uint16).tobytes(),
        "tfs": tfs.T[own, docs].astype(np.int32).tobytes(),
    }
    return row, tfs


@pytest.mark.parametrize("settings", [{}, {"DENSE_TERMS": 5}, {"DENSE_CELLS": 3000, "BLOCK_DOCS": 4}, {"DENSE_CELLS": 1}])
def test_a_shard_gives_the_best_of_all_scores(monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(module, name, value)
    rng = np.random.default_rng(4)
    row, tfs = shard_of(rng, 203, 90)
    lengths, mean, top = tfs.sum(axis=1), 70.0, 6
    impacts = tfs * 2.2 / (tfs + 1.2 * (0.25 + 0.75 * lengths[:, None] / mean))
    # Terms in the vocabulary, some of which the shard does not have.
    vocabulary = np.arange(0, 400, dtype=np.uint64)
    queries = [np.sort(rng.choice(400, size, replace=False)) for size in (1, 5, 40, 200, 400)]
    weighted = [(q.astype(np.int32), rng.gamma(1.0, 2.0, len(q))) for q in queries]
    shard = Shard(row, mean, vocabulary)
    ids = np.array(row["ids"])
    want = []
    for terms, weights in weighted:
        by_term = np.zeros(400)
        by_term[terms] = weights
        scores = np.round(impacts @ by_term[np.arange(90) * 3], 6)
        order = [d for d in np.lexsort((ids, -scores)) if scores[d] > 0][:top]
        want.append([(d, scores[d]) for d in order])

    def found(least):
        owners, places, scores = shard.best(weighted, top, least)
        return [[(p, s) for o, p, s in zip(owners, places, scores) if o == k] for k in range(len(queries))]

    def like(got, expected):
        return [p for p, _ in got] == [p for p, _ in expected] and all(abs(a[1] - b[1]) < 2e-6 for a, b in zip(got, expected))

    assert all(map(like, found(np.zeros(5)), want))
    # Those not below a score known already are all found.
    least = np.array([w[len(w) // 2][1] if w else 0.0 for w in want])
    for got, expected, bound in zip(found(least), want, least):
        assert like([x for x in got if x[1] >= bound], [x for x in expected if x[1] >= bound])
    assert not len(shard.best(weighted, top, np.full(5, 1e6))[0])
