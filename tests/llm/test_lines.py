import os
import random
from contextlib import contextmanager

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from namelens.llm import lines as module
from namelens.llm.lines import dedup_lines, lines_of, normalised, parities


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute_force(rows, similarity=0.8):
    """Removed line places by row, from all pairs of different lines."""
    places = [(d, t, k, n) for d, t in rows for k, n in enumerate(normalised(t)) if n]
    lines = sorted({n for *_, n in places})
    parent = {n: n for n in lines}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(lines):
        for j in range(i):
            b = lines[j]
            most = int((1 - similarity) * max(len(a.split()), len(b.split())) + 1e-9)
            if distance(a.split(), b.split()) <= most:
                parent[root(a)] = root(b)
    first, gone = {}, {}
    for d, t, k, n in sorted(places, key=lambda p: (p[0], p[2])):
        if first.setdefault(root(n), (d, k)) != (d, k):
            gone.setdefault(d, set()).add(k)
    return gone


def test_like_brute_force(docs):
    rng = random.Random(3)
    base = [" ".join(f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{chr(97 + rng.randrange(26))}" for _ in range(25)) for _ in range(12)]
    rows = []
    for doc in range(40):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            words = rng.choice(base).split()
            if rng.random() < 0.5:
                words[rng.randrange(25)] = "zz"
            line = " ".join(words)
            lines.append(line.upper() + "." if rng.random() < 0.2 else line)
        rows.append((doc, "\n".join([*lines, "", f"only {chr(97 + doc % 26) * (doc + 3)}"])))
    gone = brute_force(rows)
    found = {r.doc_id: r for r in dedup_lines(docs(rows)).collect()}
    for doc, text in rows:
        kept = [line for k, line in enumerate(text.split("\n")) if k not in gone.get(doc, ())]
        assert (found[doc].kept_text, found[doc].n_removed) == ("\n".join(kept), len(gone.get(doc, ())))
    assert sum(map(len, gone.values())) > 40


def test_awkward_rows(awkward, nothing):
    found = dedup_lines(awkward).collect()
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(r)
    assert len(found) == awkward.count()
    # Repeated rows are one document; its copy under another id loses its line.
    assert [r.kept_text for r in by_id[1]] == ["alpha beta gamma delta epsilon zeta"] * 2
    assert by_id[2][0].kept_text == "" and by_id[2][0].n_removed == 1
    assert by_id[3][0].kept_text is None and by_id[3][0].n_lines == 0
    assert by_id[4][0].kept_text == "" and by_id[5][0].kept_text == " \n\t \n"
    assert sorted(r.n_removed for r in by_id[7]) == [0, 1]
    assert by_id[1][0]["_key"] == "k" and by_id[1][0].places == "p"
    assert dedup_lines(nothing).collect() == []


def test_lines_that_differ_in_numbers_are_different_lines(docs):
    lines = ["Total 14,200 paid 2021", "Total 9 paid", "x 1.5", "x 15", "x 1 5", "x -5", "x 5", "2021", "2021", "TOTAL 9, paid."]
    found = {r.doc_id: r.kept_text for r in dedup_lines(docs(list(enumerate(lines)))).collect()}
    assert [found[k] for k in range(9)] == lines[:9] and found[9] == ""
    assert normalised("A-1 costs $1,200.50, or -3.\n12 - 13\n") == [b"a 1 costs 1,200.50 or -3", b"", b""]


def test_lines_at_the_threshold_are_linked(docs):
    rng = random.Random(5)
    rows, want = [], 0
    for n in (5, 10, 12, 13, 20, 36, 60, 120):
        for similarity in (0.8, 0.85, 0.9, 0.95):
            for _ in range(10):
                words = [f"w{rng.randrange(10**9)}" for _ in range(n)]
                other = words[:]
                edits = int((1 - similarity) * n + 1e-9)
                for at in rng.sample(range(n), edits):
                    other[at] = f"v{rng.randrange(10**9)}"
                rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(other))]
                want += 1
        # One edit too many.
        far = [f"f{n}x{k}" for k in range(n)]
        rows += [(len(rows), " ".join(far)), (len(rows) + 1, " ".join(["y"] * (n // 5 + 1) + far[n // 5 + 1 :]))]
    found = [r.doc_id for r in dedup_lines(docs(rows)).where("n_removed > 0").collect()]
    assert all(k % 2 for k in found) and want * 0.97 <= len(found) <= want


def test_several_edits_like_brute_force(docs):
    rng = random.Random(6)
    base = [[f"{chr(97 + b)}{chr(97 + rng.randrange(26))}{chr(97 + k % 26)}" for k in range(25)] for b in range(10)]
    rows = []
    for doc in range(40):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            words = rng.choice(base)[:]
            for _ in range(rng.randrange(4)):
                words[rng.randrange(25)] = f"z{rng.randrange(50)}"
            lines.append(" ".join(words))
        rows.append((doc, "\n".join(lines)))
    gone = brute_force(rows)
    found = {r.doc_id: r.n_removed for r in dedup_lines(docs(rows)).collect()}
    assert found == {doc: len(gone.get(doc, ())) for doc, _ in rows} and sum(found.values()) > 40


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=40), st.lists(st.integers(0, 300), min_size=1, max_size=40))
def test_marks_differ_in_few_bits_where_few_words_do(a, b):
    words = np.array([*a, *b], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    differ = sum(int(np.bitwise_count(m[0] ^ m[1])) for m in parities(words, np.array([0, len(a)])))
    assert differ <= 2 * distance(a, b) - abs(len(a) - len(b))


def test_a_task_sketches_a_repeated_line_once(docs, monkeypatch):
    rows = [(k, f"the same line again and again\nonly {chr(97 + k) * 5} here") for k in range(20)]
    found = lines_of(docs(rows).coalesce(1)).collect()
    assert len(found) == 40 and sum(r.new for r in found) == 21
    # Lines of several small batches, and a task that forgets, give the same result.
    want = sorted(map(tuple, dedup_lines(docs(rows)).select("doc_id", "n_removed", "kept_text").collect()))
    monkeypatch.setattr(module, "HELD_WORDS", 10)
    monkeypatch.setattr(module, "SEEN_LINES", 3)
    monkeypatch.setattr(module, "PIECE_ROWS", 2)
    assert sorted(map(tuple, dedup_lines(docs(rows)).select("doc_id", "n_removed", "kept_text").collect())) == want
    assert sum(n for _, n, _ in want) == 19


def test_sketches_are_removed_when_their_buckets_are_found(docs, monkeypatch):
    tables = []
    within = module.stored_within
    monkeypatch.setattr(module, "lines_of", lambda d: tables.append(lines_of(d)) or tables[-1])
    paths = []

    @contextmanager
    def watched(df, label):
        with within(df, label) as rows:
            paths.extend(f.removeprefix("file://") for f in rows.inputFiles())
            assert paths and all(map(os.path.exists, paths))
            yield rows

    monkeypatch.setattr(module, "stored_within", watched)
    found = dedup_lines(docs([(1, "one line of words"), (2, "one line of words")]))
    assert len(tables) == 1 and not any(map(os.path.exists, paths))
    assert sorted((r.doc_id, r.n_removed) for r in found.collect()) == [(1, 0), (2, 1)]
