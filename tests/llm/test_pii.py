import random
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from namelens.llm.pii import KINDS, base_spans, find_personal_data, passes_luhn, score_graph, slots

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def by_pattern(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2 and not (12 <= len(digits) <= 19 and passes_luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), kind, m.end()))
    return sorted(found)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@-+ (9%é0", max_size=40) | st.text(alphabet="0123456789 -.+", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert base_spans(text) == by_pattern(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "+1" * 100_000, "a@" * 100_000, "+1" + "(" * 300_000):
        base_spans(text)


def test_luhn():
    assert passes_luhn("4539578763621486") and not passes_luhn("4539578763621487")


def spans(df):
    return {r.doc_id: [(s.start, KINDS[s.kind], s.end) for s in r.spans] for r in df.collect()}


def test_patterns_find_unseen_identifiers(docs):
    # "mailto" mostly precedes addresses, "the" mostly does not.
    rows = [(i, f"write mailto user{i}@mail{i}.example.com about the things of the day") for i in range(8)]
    rows += [(20 + i, f"the user{i}@other{i}.example.com likes the words of the text and the rest") for i in range(4)]
    rows += [(30, "please mailto jane.77(at)corp now"), (31, "the number 123456 is the answer"), (32, "login=joe99x")]
    rows += [(40 + i, f"login=anna{i}@site{i}.example.org") for i in range(4)]
    found = spans(find_personal_data(docs(rows)))
    assert found[30] == [(14, "id", 29)]
    assert found[31] == []
    assert found[32] == [(6, "id", 12)]
    assert [k for _, k, _ in found[40]] == ["email"]
    assert all(len(found[i]) == 1 for i in range(8))


def test_awkward_rows(awkward, nothing, docs):
    found = find_personal_data(awkward)
    assert found.columns == [c for c in awkward.columns if c != "spans"] + ["spans"]
    got = found.collect()
    assert len(got) == awkward.count() and all(r.spans == [] for r in got)
    assert find_personal_data(nothing).collect() == []
    twice = docs([(1, "é 🙂 a@b.cd 10.0.0.1"), (1, "é 🙂 a@b.cd 10.0.0.1"), (None, "a@b.cd")])
    found = [[(s.start, s.kind, s.end) for s in r.spans] for r in find_personal_data(twice).collect()]
    assert sorted(found) == [[(0, 0, 6)], [(4, 0, 10), (11, 1, 19)], [(4, 0, 10), (11, 1, 19)]]


def test_words_around_long_runs_take_linear_time():
    """Texts of a megabyte without blanks, and words as long beside each other."""
    start = time.time()
    for text in ("a@b.cc," * 150_000, ("a@b.cc," * 75_000 + " ") * 2, "k=1234567,x " * 80_000):
        found = slots(text, base_spans(text))
        assert len(found) in (150_000, 80_000)
    assert time.time() - start < 30
    assert {p["word"] for p in found[1]["patterns"]} == {"k=1234567,x"}


def test_neighbours_like_plain_splitting():
    rng = random.Random(2)
    parts = ["a@b.cc", "key=12345", "x", " ", "  ", "\n", "4111 1111 1111 1111", "+49 30 1234567", "1.2.3.4", "id:AB-99x", ",", "é", "99999"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(0, 14)))
        for slot in slots(text, base_spans(text)):
            first = max(text.rfind(c, 0, slot["start"]) for c in " \n") + 1
            last = re.compile(r"\S*").match(text, slot["end"]).end()
            before, after = text[:first].lower().split(), text[last:].lower().split()
            found = {p["side"]: p["word"] for p in slot["patterns"]}
            assert (found.get("L"), found.get("R")) == (before[-1] if before else None, after[0] if after else None)


def test_identifiers_and_keys_of_any_length_with_or_without_digits(docs):
    long_key, token = "k" * 300, "x9" * 400
    rows = [(i, f"login=anna{i}@site{i}.example.org and {long_key}=bob{i}@site{i}.example.org") for i in range(6)]
    rows += [(10, f"login={token} then"), (11, "login=janedoe then"), (12, 'login="jane.doe", then'), (13, "login=ann")]
    rows += [(14, f"{long_key}=swordfish"), (15, "note:swordfisher with plain words"), (16, "login= 12 login:")]
    found = spans(find_personal_data(docs(rows)))
    assert found[10] == [(6, "id", 6 + len(token))]
    assert found[11] == [(6, "id", 13)] and found[12] == [(7, "id", 15)]
    assert found[14] == [(301, "id", 310)]
    assert found[13] == found[15] == found[16] == []


def plain_scores(edges, totals, rounds):
    """Scores of patterns and instances from their definition."""
    of = {(("K" if s == "K" else "W"), w) for s, w, *_ in edges}
    assert of <= set(totals)
    instances = {}
    for _, _, i, _, seed in edges:
        instances[i] = max(instances.get(i, 0.0), float(seed))
    seeds, scores = {i for i, v in instances.items() if v}, {}
    for _ in range(rounds):
        for side, word in {e[:2] for e in edges}:
            own = [(instances[i], n) for s, w, i, n, _ in edges if (s, w) == (side, word)]
            enough = sum(v >= 0.5 for v, _ in own) >= 3
            total = totals["K" if side == "K" else "W", word]
            scores[side, word] = min(1.0, sum(v * n for v, n in own) / total) if enough else 0.0
        for i in instances:
            miss = 1.0
            for s, w, j, _, _ in edges:
                if j == i:
                    miss *= 1 - min(scores[s, w], 0.999)
            instances[i] = 1.0 if i in seeds else 1 - miss
    return scores, instances


def test_graph_scores_like_brute_force(spark):
    rng = random.Random(8)
    seeds = {f"i{k}" for k in range(12)}
    pairs = {(rng.choice("LRK"), f"w{rng.randrange(5)}", f"i{rng.randrange(40)}") for _ in range(220)}
    edges = [(*p, rng.randrange(1, 4), p[2] in seeds) for p in sorted(pairs)]
    held = {}
    for side, word, _, n, _ in edges:
        held["K" if side == "K" else "W", word] = held.get(("K" if side == "K" else "W", word), 0) + n
    totals = {k: n + rng.randrange(6) for k, n in held.items()}
    patterns, instances = score_graph(
        spark.createDataFrame(edges, "side string, word string, instance string, n bigint, seed boolean"),
        spark.createDataFrame([(*k, n) for k, n in totals.items()], "kind string, word string, total bigint"),
    )
    want_patterns, want_instances = plain_scores(edges, totals, 3)
    found = {(r.side, r.word): r.pattern_score for r in patterns.collect()}
    assert found.keys() == want_patterns.keys()
    assert all(abs(found[k] - v) < 1e-9 for k, v in want_patterns.items())
    found = {r.instance: r.score for r in instances.collect()}
    assert found.keys() == want_instances.keys()
    assert all(abs(found[k] - v) < 1e-9 for k, v in want_instances.items())
    assert any(0 < v < 1 for v in want_instances.values())
