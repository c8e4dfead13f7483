import random
from collections import Counter
from math import comb

from pyspark.sql import functions as F

from namelens.llm.mixing import (
    hypergeometric,
    mix_documents,
    place_of,
    plan_mix,
    sized,
    split_quotas,
    targets,
    with_copies,
)


def filled(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by resharing the excess until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        level = (total - sum(fixed.values())) / max(1, sum(weight[s] for s in rest))
        above = [s for s in rest if level * weight[s] > most * sizes[s]]
        if not above:
            return {**fixed, **{s: level * weight[s] for s in rest}}
        fixed.update({s: most * sizes[s] for s in above})


def documents(seed, sources=7, count=400):
    rng = random.Random(seed)
    names = [None, "", "b", "é", "Z", "a", "🙂"][:sources]
    return [
        (i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 30, 200]))), rng.choice(names[: 1 + i % sources]))
        for i in range(count)
    ]


def test_targets_and_taken_words(docs):
    rows = documents(1)
    found = docs(rows)
    plan = sized(found)
    taken = with_copies(plan, plan_mix(plan, block_words=300, shard_words=1500))
    got = {r.doc_id: r for r in taken.collect()}
    sizes = Counter()
    for i, text, source in rows:
        sizes[source] += len(text.split())
    want = filled(sizes)
    words = Counter()
    for i, text, source in rows:
        r = got[i]
        assert abs(r.target - want[source]) < 1e-6 and r.source_size == sizes[source]
        assert len(r._shards) <= 2
        words[source] += r._size * len(r._shards)
    for source, target in want.items():
        assert abs(words[source] - target) <= 0.02 * target + 15


def test_shards_are_filled_exactly_and_reruns_agree(docs):
    rows = documents(2, 3)
    mixed = mix_documents(docs(rows), block_words=50, shard_words=800)
    assert mixed.columns == [c for c in docs(rows).columns if c != "shard"] + ["shard"]
    first = sorted((r.doc_id, r.shard) for r in mixed.collect())
    again = sorted((r.doc_id, r.shard) for r in mix_documents(docs(rows[::-1]), block_words=50, shard_words=800).collect())
    assert first == again and len({s for _, s in first}) > 10


def test_quotas_add_up(spark):
    counts = [700, 0, 41, 3, 1]
    rows = spark.createDataFrame([(counts,)], "counts array<bigint>")
    found = split_quotas(rows, 13, 5).orderBy("shard").collect()
    assert [r.shard for r in found] == list(range(13))
    assert [sum(r.counts[s] for r in found) for s in range(5)] == counts
    assert max(sum(r.counts) for r in found) - min(sum(r.counts) for r in found) <= 1
    assert all(n >= 0 for r in found for n in r.counts)


def test_draws_have_the_hypergeometric_distribution(spark):
    n, good, drawn = 20, 7, 9
    sql = hypergeometric(f"{good}L", f"{n}L", f"{drawn}L", "u")
    draws = spark.range(4000).select(((F.col("id") + 0.5) / 4000).alias("u")).select(F.expr(sql).alias("k"))
    got = {r.k: r["count"] / 4000 for r in draws.groupBy("k").count().collect()}
    for k in range(8):
        want = comb(good, k) * comb(n - good, drawn - k) / comb(n, drawn)
        assert abs(got.get(k, 0) - want) < 0.001


def test_awkward_rows(awkward, nothing):
    mixed = mix_documents(awkward, block_words=10, shard_words=100)
    counts = Counter(r.doc_id for r in mixed.collect())
    assert all(n <= 2 * 3 for n in counts.values())
    assert mix_documents(nothing).collect() == []
    blank = awkward.where("doc_id in (3, 4, 5)")
    assert all((r.text or "").strip() == "" for r in mix_documents(blank).collect())
    found = targets(sized(awkward)).collect()
    assert [r.target for r in found] == [1.5 * r.source_size for r in found]


def test_places_do_not_depend_on_the_partitioning(docs):
    rows = docs([(i, f"t{i}") for i in range(50)])
    place = place_of(F.col("doc_id"), F.col("text"), 1).alias("p")
    one = {r.doc_id: r.p for r in rows.select("doc_id", place).collect()}
    other = {r.doc_id: r.p for r in rows.repartition(7).select("doc_id", place).collect()}
    assert one == other and all(0 <= p < 1 << 60 for p in one.values())
