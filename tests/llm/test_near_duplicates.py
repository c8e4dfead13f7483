import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from namelens.llm.linking import BUCKETS, bucket_columns, components, linked_groups, shared_buckets, shared_groups
from namelens.llm.near_duplicates import (
    SCHEMES,
    _banded,
    all_sketches,
    anchored_edits,
    drop_near_duplicates,
    edit_distance,
    near_enough,
    near_groups,
    one_gap_edits,
    sketches,
    text_sketches,
    words_in_common,
)
from namelens.llm.rows import keyed

from .conftest import LONG

SEQUENCE = st.lists(st.integers(0, 3), max_size=25)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(SEQUENCE, SEQUENCE, st.integers(0, 12))
def test_alignment_is_the_edit_distance(a, b, most):
    want = distance(a, b)
    x, y = np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64)
    assert edit_distance(x, y, most) == (want if want <= most else None)
    assert near_enough(x, y, most) == (want <= most)
    assert max(len(a), len(b)) - words_in_common(x, y) <= want <= anchored_edits(x, y)
    if a and b and abs(len(a) - len(b)) <= most:
        assert _banded(x, y, most) == (want if want <= most else None)


def test_many_edits_use_the_band():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 60, 600).astype(np.uint64)
    b = a.copy()
    b[::8] = 1
    assert edit_distance(a, b, 120) == 75
    assert edit_distance(a, b, 74) is None


def test_lengths_that_differ_by_more_than_the_first_band():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 60, 700).astype(np.uint64)
    for cut in (30, 60, 100, 139):
        b = np.concatenate([a[:200], a[200 + cut :]])
        b[::40] = 1
        want = cut + len(b[::40])
        assert edit_distance(a, b, want) == want and edit_distance(b, a, want) == want
        assert edit_distance(a, b, want - 1) is None


def test_sketches_keep_the_order_of_the_text():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 1 << 60, 300).astype(np.uint64)
    turned = np.concatenate([words[150:], words[:150]])
    same = (sketches(words) == sketches(words)).mean()
    moved = (sketches(words) == sketches(turned)).mean()
    assert same == 1 and 0.1 < moved < 0.8


@pytest.mark.parametrize("n", [5, 10, 12, 13, 20, 32, 41, 60, 200, 1000])
@pytest.mark.parametrize("similarity", [0.8, 0.85, 0.9, 0.95])
def test_pairs_at_the_threshold_share_a_bucket(n, similarity):
    rng = np.random.default_rng(n)
    edits = int((1 - similarity) * n + 1e-9)
    found, pairs = 0, 200 if n < 1000 else 60
    for _ in range(pairs):
        a = rng.integers(0, 1 << 60, n).astype(np.uint64)
        b = a.copy()
        at = rng.choice(n, edits, replace=False)
        b[at] += np.uint64(1)
        if rng.random() < 0.3 and edits:
            b = np.delete(a, at)
        found += bool(np.intersect1d(text_sketches(a), text_sketches(b)).size)
    assert found >= 0.97 * pairs, found / pairs


def variants(rng, words, n, edits):
    out = []
    for _ in range(n):
        own = words[:]
        for _ in range(edits):
            own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def test_groups_like_all_pairs(docs):
    rng = random.Random(4)
    texts = []
    for g in range(6):
        base = [f"g{g}w{rng.randrange(200)}" for _ in range(80)]
        texts += variants(rng, base, 5, 3) + [" ".join(base), "  ".join(base)]
    texts += [" ".join(f"u{i}x{k}" for k in range(50)) for i in range(10)] + ["few words", "few  words", "few wordz"]
    rows = list(enumerate(texts))
    found = near_groups(docs(rows)).join(keyed(docs(rows)).select("doc_id", "_doc", "_key"), ["_doc", "_key"])
    group = {r.doc_id: r.group for r in found.collect()}
    split = [t.split() for t in texts]
    for i, a in enumerate(split):
        for j in range(i):
            b = split[j]
            # Texts of different families share no word.
            family = i // 7 == j // 7 if i < 42 else j >= 42
            near = family and distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9)
            assert (group[i] == group[j]) == near, (i, j)


def test_one_document_of_each_group_stays(docs, awkward, nothing):
    words = [f"w{i}" for i in range(100)]
    other = words[:50] + ["x"] + words[51:]
    kept = drop_near_duplicates(docs([(3, " ".join(words)), (2, " ".join(other)), (9, "something else here")]))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 9]
    kept = drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect())
    # Copies and repeated rows go; texts without words all stay.
    assert [i for n, i, _ in ids if not n] == [1, 3, 4, 5, 6, 7, 7, 8]
    assert sum(n for n, *_ in ids) == 2
    assert any(t == LONG for *_, t in ids)
    assert drop_near_duplicates(nothing).collect() == []


def test_components_of_chains_and_stars(rows):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(130, 129), (7, 7)]
    found = {r.node: r.root for r in components(rows(edges, "a bigint, b bigint")).collect()}
    assert {found[i] for i in range(41)} == {0} and {found[i] for i in range(100, 131)} == {100}


def test_no_link_is_lost_where_the_head_is_unlike(rows):
    # In bucket 1 the least member is near nobody, the others are near in pairs.
    members = [(1, i, i * 1000 if i < 2 else 5000 + i // 2 * 100) for i in range(10)]
    near = lambda x, y: F.abs(x - y) < 50
    found = linked_groups(rows(members, "bucket bigint, id bigint, trait bigint"), near, lambda pairs: pairs)
    groups = {}
    for r in found.collect():
        groups.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, groups.values())) == [[2, 3], [4, 5], [6, 7], [8, 9]]


def test_buckets_are_shuffled_in_rounds_and_all_are_linked(rows, monkeypatch):
    from namelens.llm import linking

    labels = []
    store = linking.stored
    monkeypatch.setattr(linking, "stored", lambda df, label: labels.append(label) or store(df, label))
    # Pairs in buckets of every round, and one member in buckets of two rounds.
    members = [(b, id_, id_) for b in range(linking.ROUNDS) for id_ in (10 * b, 10 * b + 1)]
    members += [(3, 99, 31), (12, 99, 31)]
    near = lambda x, y: F.abs(x - y) < 5
    found = linked_groups(rows(members, "bucket bigint, id bigint, trait bigint"), near, lambda pairs: pairs)
    groups = {}
    for r in found.collect():
        groups.setdefault(r.root, set()).add(r.node)
    expected = [[10 * b, 10 * b + 1] for b in range(linking.ROUNDS) if b != 3] + [[30, 31, 99]]
    assert sorted(map(sorted, groups.values())) == sorted(expected)
    assert labels.count("heads") == linking.ROUNDS


def test_texts_sketched_together_have_the_sketches_of_each_alone():
    rng = np.random.default_rng(8)
    schemes = (*SCHEMES, (lambda s: s._replace(kmers=5, count=7))(SCHEMES[1]))
    sizes = np.array([0, 1, 2, 3, 4, 9, 9, 12, 12, 12, 35, 40, 41, 60, 60, 0, 9000, 30_000])
    # Many words repeat, so occurrence numbers matter.
    words = rng.integers(0, 40, int(sizes.sum())).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    first = np.cumsum(sizes) - sizes
    found, ends = all_sketches(words, first, sizes, schemes)
    assert len(found) == ends[-1]
    for a, n, x, y in zip(first, sizes, ends, ends[1:]):
        alone = text_sketches(words[a : a + n], schemes) if n else np.zeros(0, dtype=np.uint64)
        assert np.array_equal(found[x:y], alone)


@settings(max_examples=200, deadline=None)
@given(SEQUENCE, SEQUENCE)
def test_an_alignment_with_one_gap_has_no_fewer_edits(a, b):
    x, y = np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64)
    n, gap = min(len(a), len(b)), abs(len(a) - len(b))
    short, long = sorted((a, b), key=len)
    want = gap + min(sum(p != q for p, q in zip(short, long[:i] + long[i + gap :])) for i in range(n + 1))
    assert distance(a, b) <= one_gap_edits(x, y) == one_gap_edits(y, x) == want


def packs(spark, members):
    """Members (id, buckets) as the rows that ``shared_buckets`` takes."""
    buckets = np.array([b for _, own in members for b in own], dtype=np.uint64)
    ends = np.cumsum([0, *[len(own) for _, own in members]])
    columns = [c.to_pylist() for c in bucket_columns(buckets, ends)]
    schema = "id bigint, " + ", ".join(f"{b} binary" for b in BUCKETS)
    return spark.createDataFrame([(i, *x) for (i, _), x in zip(members, zip(*columns))], schema).repartition(3)


def test_shared_buckets_like_brute_force(spark, monkeypatch):
    from namelens.llm import linking

    monkeypatch.setattr(linking, "PART_ENTRIES", 60)
    rng = random.Random(9)
    values = [rng.randrange(1 << 64) for _ in range(150)]
    members = [(rng.randrange(-50, 50) << 40, [*set(rng.choices(values, k=rng.randrange(12)))]) for _ in range(120)]
    # Ids in several rows, and a bucket that most have.
    members += members[:20]
    members += [(i, [values[0]]) for i in range(300)]
    held = {}
    for i, own in members:
        for b in own:
            held.setdefault(b, set()).add(i)
    want = [((b ^ (1 << 63)) - (1 << 63), i, min(ids), len(ids)) for b, ids in held.items() for i in ids if len(ids) > 1]
    assert sorted(map(tuple, shared_buckets(packs(spark, members)).collect())) == sorted(want)
    assert shared_buckets(packs(spark, members).limit(0)).collect() == []


def test_groups_of_packed_buckets_are_those_of_rows(rows, spark):
    rng = random.Random(10)
    values = [rng.randrange(1 << 64) for _ in range(40)]
    traits = [(i, rng.randrange(300)) for i in range(120)]
    members = [(i, rng.sample(values, 3)) for i, _ in traits]
    near = lambda x, y: F.abs(x - y) < 6
    verified = lambda pairs: pairs.where("(a + b) % 3 > 0")
    found = shared_groups(shared_buckets(packs(spark, members)), rows(traits, "id bigint, trait bigint"), near, verified)
    trait = dict(traits)
    signed = [((b ^ (1 << 63)) - (1 << 63), i, trait[i]) for i, own in members for b in own]
    want = linked_groups(rows(signed, "bucket bigint, id bigint, trait bigint"), near, verified)
    # The least id of a group is its root; every pair in a bucket is linked or apart.
    parent = {i: i for i in trait}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    own = {i: set(b) for i, b in members}
    linked = set()
    for a in trait:
        for b in range(a):
            if own[a] & own[b] and abs(trait[a] - trait[b]) < 6 and (a + b) % 3:
                linked |= {a, b}
                parent[max(root(a), root(b))] = min(root(a), root(b))
    expected = sorted((i, root(i)) for i in linked)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect())) == expected
    assert len(expected) > 30
