import random

from pyspark.sql import functions as F

import corpus_pipeline
from namelens.llm.queries import ORACLES, QUERIES

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus():
    rng = random.Random(9)
    stems = ["ab", "cor", "den", "fil", "gar", "hom", "jun", "lat", "mor", "nel", "pit", "ros"]
    word = lambda: "".join(rng.choice(stems) for _ in range(rng.randrange(1, 4)))
    rows, labels = [], []
    for i in range(160):
        lines = [" ".join(word() for _ in range(rng.randrange(8, 30))) for _ in range(rng.randrange(1, 5))]
        if i % 5 == 0:
            lines = [line + " zork" + word() + " quav" + word() for line in lines]
        rows.append((i, "\n".join(lines), "en", f"s{i % 3}", None))
        labels.append((i, 1, int(i % 5 == 0)))
    first = rows[1][1]
    rows += [(200, first, "en", "s1", None), (201, rows[2][1] + "\n" + rows[3][1].split("\n")[0], "en", "s2", None)]
    words = " ".join(word() for _ in range(120)).split()
    near = words[:60] + ["other"] + words[61:]
    # The lines are cut at different words, so only whole texts are near.
    rows.append((210, "\n".join(" ".join(words[k : k + 12]) for k in range(0, 120, 12)), "en", "s0", None))
    rows.append((211, "\n".join(" ".join(near[k : k + 17]) for k in range(0, 120, 17)), "en", "s0", None))
    rows += [(220, None, None, None, None), (221, "", "en", None, 0), (221, "", "en", None, 0), (None, "no id here", "en", "s1", 10)]
    return rows, labels


def test_stages(spark, tmp_path):
    rows, labels = corpus()
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "mixing", "bpe"]
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        found = stage(spark, docs, str(tmp_path))
        assert found.columns[:5] == docs.columns if name == "bpe" else found.columns == docs.columns
        found.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = docs.collect()
    ids = {n: {r.doc_id for r in kept[n]} for n in names}
    toxic = {i for i, _, t in labels if t}
    assert len(ids["toxicity"] & toxic) <= 2
    assert len(ids["toxicity"] - toxic) >= 130
    texts = {r.doc_id: r for r in kept["line_dedup"]}
    assert 200 not in texts and 1 in texts
    assert {220, 221, None} <= ids["line_dedup"]
    lines = [x for r in kept["line_dedup"] for x in (r.text or "").split("\n") if x]
    assert len(lines) == len(set(lines))
    assert all(r.n_chars in (None, 0, 10) or r.n_chars == len(r.text) for r in kept["line_dedup"])
    assert len({210, 211} & ids["near_dedup"]) == 1
    assert all(r.round_trip for r in kept["bpe"])
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in whole.collect()) == sorted(
        (r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in kept["bpe"]
    )


def test_stages_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], DOCUMENTS)
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


def test_columns_of_the_caller_pass_all_stages(spark, tmp_path):
    ddl = "doc_id bigint, text string, lang string, source string, n_chars bigint, toxic_score double, kept_text string, n_removed string, shard int, `a.b` string, n_tokens string, _row int"
    rows = [(i, f"document {i} says {' '.join(f'w{i}x{k}' for k in range(12))}", "en", "s", None, 0.5, "kept", "r", 7, f"dot {i}", "t", i) for i in range(6)]
    docs = spark.createDataFrame(rows, ddl)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(3)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.columns[: len(columns)] == columns or name == "bpe", name
    found = docs.collect()
    assert len(found) >= 6 and docs.columns == [c for c in columns if c != "n_tokens"] + ["n_tokens", "ids", "round_trip"]
    assert all((r["toxic_score"], r["kept_text"], r["n_removed"], r["shard"], r["a.b"], r["_row"]) == (0.5, "kept", "r", 7, f"dot {r['doc_id']}", r["doc_id"]) for r in found)
