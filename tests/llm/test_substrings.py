import hashlib
import random
import re

import pytest

from namelens.llm.substrings import remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(rows, window):
    """(n_words, n_removed, kept) by (id, text): windows seen in an earlier document or place."""
    seen, out = {}, {}
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            first = seen.setdefault(key, (doc, text, p))
            if first[0] != doc or first[1] == text and first[2] < p:
                gone[p : p + window] = [True] * window
        out[doc, text] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
    return out


@pytest.mark.parametrize("window", [6, 20])
def test_like_brute_force(spark, docs, window):
    rng = random.Random(window)
    phrase = [f"p{i}" for i in range(60)]
    rows = []
    for doc in range(60):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(0, 90))]
        for _ in range(rng.randrange(3)):
            at, size = rng.randrange(len(words) + 1), rng.randrange(4, 50)
            start = rng.randrange(60 - size) if size < 60 else 0
            words[at:at] = phrase[start : start + size]
        rows.append((doc, " \n".join(words)))
    rows += [(100 + i, rows[i][1]) for i in range(8)] + [(200, "a " * 100), (201, "a " * 70)]
    found = remove_repeats(docs(rows), window)
    want = brute_force(rows, window)
    got = {(r.doc_id, r.text): (r.n_words, r.n_removed, r.kept_text) for r in found.collect()}
    assert got == want
    assert sum(n for _, n, _ in want.values()) > 500


def test_awkward_rows(awkward, nothing):
    found = remove_repeats(awkward, 3)
    passed_on = [c for c in awkward.columns if c not in ("kept_text", "spans")]
    assert found.columns == [*passed_on, "n_words", "n_removed", "kept_text", "spans"]
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    want = brute_force(rows, 3)
    got = [(r.doc_id, r.text, r.n_words, r.n_removed, r.kept_text) for r in found.collect()]
    assert len(got) == len(rows)
    assert all(want[d, t] == (n, k, x) for d, t, n, k, x in got)
    assert remove_repeats(nothing, 3).collect() == []


def test_spans_are_the_removed_words(docs):
    found = {r.doc_id: r for r in remove_repeats(docs([(1, "a b c d"), (2, "x a b c y a b c")]), 3).collect()}
    assert found[2].spans == [[1, 4], [5, 8]] and found[2].kept_text == "x y"
    assert hashlib.sha256(found[1].kept_text.encode()).hexdigest() == hashlib.sha256(b"a b c d").hexdigest()
