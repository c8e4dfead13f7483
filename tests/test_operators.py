from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from namelens.functions import record_order
from namelens.operators import (
    add_absent,
    delete_matching,
    insert_absent,
    keyed_join,
    measured_bytes,
    ranked,
    scratch_dir,
    snapshot,
    update_matching,
    upsert,
    with_new_ids,
)

T = "k string, a int, b int"


def as_set(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_upsert_updates_and_inserts_once(rows):
    target = rows([("x", 1, 1), ("y", 2, 2), (None, 9, 9)], T)
    source = rows([("y", 20, 20), ("z", 30, 30)], T)
    once = upsert(target, source, ["k"])
    expected = [("x", 1, 1), ("y", 20, 20), ("z", 30, 30), (None, 9, 9)]
    assert as_set(once) == sorted(expected, key=repr)
    assert as_set(upsert(once, source, ["k"])) == sorted(expected, key=repr)


def test_upsert_options(rows):
    target = rows([("x", 1, 1), ("y", 2, 2)], T)
    source = rows([("y", 20, 20), ("z", 30, 30)], T)
    assert as_set(upsert(target, source, ["k"], update_cols=["a"], insert=False)) == [("x", 1, 1), ("y", 20, 2)]
    assert as_set(add_absent(target, source, ["k"])) == [("x", 1, 1), ("y", 2, 2), ("z", 30, 30)]
    marked = upsert(target, source, ["k"], set_literals={"b": F.lit(-1)}, insert_literals={"b": F.lit(-2)})
    assert as_set(marked) == [("x", 1, 1), ("y", 20, -1), ("z", 30, -2)]
    guarded = upsert(target, source, ["k"], target_pred=F.col("a") > 2)
    assert as_set(guarded) == [("x", 1, 1), ("y", 2, 2), ("y", 20, 20), ("z", 30, 30)]


def test_upsert_null_keys(rows):
    target = rows([(None, 1, 1)], T)
    source = rows([(None, 2, 2)], T)
    assert as_set(upsert(target, source, ["k"])) == [(None, 1, 1), (None, 2, 2)]
    assert as_set(upsert(target, source, ["k"], null_safe=True)) == [(None, 2, 2)]
    twice = rows([(None, 2, 2), (None, 2, 2)], T)
    for null_keys in (True, False):
        assert upsert(target, twice, ["k"], null_keys=null_keys).count() == 3


def test_upsert_rejects_a_repeated_source_key(rows):
    target = rows([("x", 1, 1)], T)
    for key in ("x", "z"):
        source = rows([(key, 2, 2), (key, 3, 3)], T)
        with pytest.raises(Exception, match="several rows for key"):
            upsert(target, source, ["k"]).collect()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(st.sampled_from("abcdefgh"), st.integers(0, 9)),
    st.dictionaries(st.sampled_from("abcdefgh"), st.integers(0, 9)),
)
def test_upsert_is_a_dictionary_update(spark, old, new):
    ddl = "k string, v int"
    target = spark.createDataFrame(list(old.items()), ddl)
    source = spark.createDataFrame(list(new.items()), ddl)
    assert as_set(upsert(target, source, ["k"])) == sorted({**old, **new}.items())


def test_insert_absent_keeps_repeats_inside_the_source(rows):
    target = rows([("x", 1, 1)], T)
    source = rows([("x", 2, 2), ("y", 3, 3), ("y", 3, 3)], T)
    assert as_set(insert_absent(target, source, ["k"])) == [("y", 3, 3), ("y", 3, 3)]


def test_delete_matching(rows):
    target = rows([("x", 1, 1), ("y", 2, 2), ("y", 3, 3), (None, 4, 4)], T)
    out = delete_matching(target, rows([("y",), (None,)], "k string"), ["k"])
    assert as_set(out) == sorted([("x", 1, 1), (None, 4, 4)], key=repr)


def test_update_matching(rows):
    target = rows([("x", 1, 1), ("y", 2, 2), ("z", 3, 3)], T)
    keys = rows([("x",), ("x",), ("y",)], "k string")
    out = update_matching(target, keys, ["k"], {"b": F.col("b") * 10}, guard=F.col("a") > 1)
    assert as_set(out) == [("x", 1, 1), ("y", 2, 20), ("z", 3, 3)]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_the_plain_join(spark, how):
    """A third of all rows under one key, and as many without a key."""
    big = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        "id",
    )
    table = spark.createDataFrame([("hot", 1), ("k2", 2), ("k5", 3), ("none", 4)], "k string, v int")
    plain = big.join(table, "k", how)
    shuffled = keyed_join(big, table, ["k"], how, broadcast_limit=0, hot_key_rows=1000, salts=8)
    broadcast = keyed_join(big, table, ["k"], how)
    columns = plain.columns
    assert as_set(shuffled.select(*columns)) == as_set(plain)
    assert as_set(broadcast.select(*columns)) == as_set(plain)


def test_salted_join_splits_the_hot_key(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(8000).select(F.lit("hot").alias("k"), "id")
        table = spark.createDataFrame([("hot", 1)], "k string, v int")
        out = keyed_join(big, table, ["k"], "left", broadcast_limit=0, hot_key_rows=100, salts=32)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 8000 and len(sizes) > 3 and max(sizes) < 5000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_large_side_is_not_broadcast(spark):
    big = spark.range(100).select((F.col("id") % 5).cast("string").alias("k"))
    table = spark.range(5).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    small = keyed_join(big, table, ["k"])
    assert "ResolvedHint (strategy=broadcast)" in small._jdf.queryExecution().analyzed().toString()
    large = keyed_join(big, table, ["k"], broadcast_limit=10)
    assert "strategy=broadcast" not in large._jdf.queryExecution().analyzed().toString()


def test_measured_bytes_counts_the_text(rows):
    short = measured_bytes(rows([("x" * 10, 1)] * 10, "a string, b int"))
    long = measured_bytes(rows([("x" * 1000, 1)] * 10, "a string, b int"))
    assert long - short == 10 * 990


def test_snapshot_uses_the_shared_folder(spark, rows):
    stored = snapshot(rows([("x", 1, 1)], T), "unit")
    assert as_set(stored) == [("x", 1, 1)]
    assert scratch_dir(spark) in stored.inputFiles()[0]


@pytest.mark.parametrize("partitions", [1, 7, None])
def test_ranked_matches_the_sorted_window(spark, partitions):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
        F.when(F.col("id") % 11 == 0, F.concat(F.lit("r"), F.col("id")))
        .otherwise(F.col("id").cast("string")).alias("record_id"),
    )
    mine = ranked(df, record_order("record_id"), by=["g"], name="n", partitions=partitions)
    df.createOrReplaceTempView("to_rank")
    theirs = spark.sql(
        "select g, record_id, row_number() over (partition by g order by "
        "try_cast(record_id as bigint) is null, try_cast(record_id as bigint), record_id) n from to_rank"
    )
    assert as_set(mine) == as_set(theirs)


def test_new_ids_follow_on(rows):
    df = with_new_ids(rows([("b",), ("a",), ("c",)], "f string"), [F.col("f")], 100)
    assert as_set(df) == [("a", 101), ("b", 102), ("c", 103)]


def test_ranked_splits_a_group_of_copies(spark):
    """All rows equal: no range gets them all, and the numbers are still 1 to n."""
    df = spark.range(4000, numPartitions=16).select(F.lit("g").alias("g"), F.lit("1").alias("record_id"))
    out = ranked(df, record_order("record_id"), by=["g"], name="n", partitions=8)
    assert [r.n for r in out.orderBy("n").collect()] == list(range(1, 4001))
