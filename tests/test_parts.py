"""Tables in parts: what is published, what is read, written and removed."""

from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from namelens import schemas
from namelens.operators import upsert
from namelens.plans.pipeline import EnrichmentError, Pipeline
from namelens.plans.refresh import Chain
from namelens.sources.export import export_lists
from namelens.sources.parts import Buckets, Parts
from namelens.sources.tables import Tables
from tests.test_pipeline import World, column, fill, now, world  # noqa: F401

KEYS = "client_id bigint, batch_id bigint"


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "tables"), buckets=8)


def people(spark, rows):
    df = spark.createDataFrame(rows, "client_id bigint, batch_id bigint, record_id string, first_name string")
    return fill(df, schemas.PERSON_INPUT)


def test_a_job_that_dies_before_it_publishes_loses_no_person(spark, tables, monkeypatch):
    tables.replace_people("person_input", people(spark, [(1, 1, "a", "Ann"), (1, 2, "b", "Bob")]))

    def die(self, rows):
        raise ConnectionError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(Parts, "_point", die)
        with pytest.raises(ConnectionError):
            tables.replace_people("person_input", people(spark, [(1, 1, "a", "New")]))
        with pytest.raises(ConnectionError):
            tables.drop_batches("person_input", spark.createDataFrame([(1, 2)], KEYS))
    assert column(tables.read_people("person_input"), "record_id", "first_name") == [("a", "Ann"), ("b", "Bob")]
    # What was written but never published goes with the next clean-up.
    tables.replace_people("person_input", people(spark, [(1, 1, "a", "New")]))
    assert column(tables.read_people("person_input"), "record_id", "first_name") == [("a", "New"), ("b", "Bob")]
    assert tables.vacuum(3600) == 0
    assert tables.vacuum(0) > 0
    assert column(tables.read_people("person_input"), "record_id", "first_name") == [("a", "New"), ("b", "Bob")]


def test_read_and_written_files_never_coincide(spark, tables):
    tables.replace_people("person_input", people(spark, [(1, 1, "a", "Ann"), (2, 2, "b", "Bob")]))
    held = tables.read_people("person_input")
    before = set(held.inputFiles())
    tables.replace_people("person_input", held.withColumn("first_name", F.upper("first_name")))
    assert before.isdisjoint(tables.read_people("person_input", held).inputFiles())
    assert column(held, "first_name") == [("Ann",), ("Bob",)]
    assert column(tables.read_people("person_input"), "first_name") == [("ANN",), ("BOB",)]


def test_dropped_batches_are_gone_from_the_disk(spark, tables, tmp_path):
    tables.replace_people("person_input", people(spark, [(1, 1, "a", "Ann"), (1, 2, "b", "Bob")]))
    tables.drop_batches("person_input", spark.createDataFrame([(1, 1), (9, 9)], KEYS))
    assert column(tables.read_people("person_input"), "record_id") == [("b",)]
    assert not list((tmp_path / "tables").rglob("batch_id=1"))


def test_a_change_writes_the_parts_it_touches(spark, tables, tmp_path, monkeypatch):
    rows = spark.range(400).select(F.lit(1).cast("bigint").alias("client_id"), F.col("id").alias("batch_id"), F.lit("PENDING").alias("processing_status"))
    tables.replace("completion_queue", fill(rows, schemas.COMPLETION_QUEUE))
    folder = tmp_path / "tables" / "keyed" / "completion_queue" / "data"
    written = lambda: {f for f in folder.rglob("*.parquet")}
    before = written()
    one = spark.createDataFrame([(1, 7, "DONE"), (1, 1000, "NEW")], f"{KEYS}, processing_status string")
    changed = tables.change("completion_queue", one, lambda old: upsert(old, one, ["client_id", "batch_id"], null_keys=False))
    assert 1 <= len(written() - before) <= 2 and len(before) == 8
    assert changed.count() < 200
    states = dict(column(tables.read("completion_queue"), "batch_id", "processing_status"))
    assert len(states) == 401 and states[7] == "DONE" and states[1000] == "NEW" and states[8] == "PENDING"
    assert tables.read("completion_queue", one).count() == changed.count()

    def die(self, pointer):
        raise ConnectionError("killed")

    monkeypatch.setattr(Buckets, "_point", die)
    with pytest.raises(ConnectionError):
        tables.change("completion_queue", one, lambda old: old.withColumn("processing_status", F.lit("LOST")))
    assert dict(column(tables.read("completion_queue"), "batch_id", "processing_status")) == states


def test_chain_refreshes_what_changed(spark, tables):
    chain = Chain(tables)
    counts = [("Ann", "F", 900, 1990), ("Bob", "M", 900, 1950)]
    tables.replace("name_counts", spark.createDataFrame(counts, "first_name string, gender string, quantity bigint, year int"))
    tables.replace_people("person_input", people(spark, [(1, 1, "a", "Ann"), (1, 2, "b", "Bob"), (1, 3, "c", "Zoe")]))
    writes = lambda: dict(column(tables.people("gender_baseline").pointer(), "batch_id", "_write"))
    flags = lambda: column(tables.read_people("gender_baseline"), "record_id", "ssa_lookup_match_flag")
    one = spark.createDataFrame([(1, 1)], KEYS)
    chain.refresh("gender_baseline", one)
    assert flags() == [("a", 1)]
    chain.refresh("gender_baseline")
    first = writes()
    assert flags() == [("a", 1), ("b", 1), ("c", 0)]
    chain.refresh("gender_baseline")
    assert writes() == first
    # One batch changed, one gone.
    tables.replace_people("person_input", people(spark, [(1, 2, "b", "Zed")]))
    tables.drop_batches("person_input", spark.createDataFrame([(1, 3)], KEYS))
    chain.refresh("gender_baseline")
    assert flags() == [("a", 1), ("b", 0)]
    assert writes()[1] == first[1] and writes()[2] != first[2]
    # A new lookup makes all batches anew.
    tables.replace("name_counts", spark.createDataFrame([("Zed", "M", 900, 1950)], "first_name string, gender string, quantity bigint, year int"))
    chain.refresh("gender_baseline")
    assert flags() == [("a", 0), ("b", 1)] and writes()[1] != first[1]
    # The clean people are stored only when they are asked for.
    assert not tables.people("person_clean").written()
    chain.refresh("person_clean")
    assert column(tables.read_people("person_clean"), "first_name_clean") == [("ann",), ("zed",)]
    chain.drop(one)
    assert column(tables.read_people("gender_baseline"), "record_id") == [("b",)]


def test_lists_of_columns_in_one_write(spark, tmp_path):
    ddl = "app_organization_id string, app_batch_id string, columns array<string>, record_id string, first_name string, last_name string, zip string, male_probability decimal(10,6), female_probability decimal(10,6), gender_confidence_level string, predicted_gender string"
    rows = [("o", "big", ["RECORD_ID", "ZIP"], str(i), "x", None, "1", None, None, None, None) for i in range(100)]
    rows += [("o", "odd", ["FIRST_NAME", "LAST_NAME", "RECORD_ID"], "7", ' a "quoted", name ', "", None, None, None, None, None)]
    export_lists(spark.createDataFrame(rows, ddl).repartition(3), str(tmp_path / "out"), rows_per_file=40)
    big = [gzip.decompress(f.read_bytes()).decode().splitlines() for f in (tmp_path / "out").rglob("app_batch_id=big/*.gz")]
    assert len(big) == 3 and all(lines[0] == "RECORD_ID,ZIP" and "RECORD_ID,ZIP" not in lines[1:] for lines in big)
    assert sorted(x for lines in big for x in lines[1:]) == sorted(f"{i},1" for i in range(100))
    odd = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/out/app_organization_id=o/app_batch_id=odd")
    assert odd.first().asDict() == {"FIRST_NAME": 'a "quoted", name', "LAST_NAME": None, "RECORD_ID": "7"} or odd.first()["LAST_NAME"] == ""


STEPS = ["stage", "change", "emit", "drop_batches"]


def failing_at(tables, number):
    """Tables whose step of that number fails, once; a list of the steps taken."""
    taken = []
    for name in STEPS:
        def step(*args, _own=getattr(tables, name), _name=name, **kwargs):
            taken.append(_name)
            if len(taken) == number:
                raise ConnectionError(f"lost at step {number}")
            return _own(*args, **kwargs)
        setattr(tables, name, step)
    return taken


def test_completion_recovers_from_a_failure_at_every_step(spark, tmp_path):
    """Fails at the first step, the second and so on; the repeat always ends in the same state."""
    number, ends = 1, []
    while True:
        tables = Tables(spark, str(tmp_path / f"tables-{number}"), buckets=1)
        tables.replace("client", fill(spark.createDataFrame([(1, "o1")], "id bigint, app_organization_id string"), schemas.CLIENT))
        batches = spark.createDataFrame([(5, 1, "b5"), (6, 1, "b6")], "id bigint, client_id bigint, app_batch_id string")
        tables.replace("client_batch", fill(batches, schemas.BATCH))
        tables.replace_people("person_input", people(spark, [(1, 5, "a", "Ann"), (1, 5, "b", "Bob"), (1, 6, "c", "Kim")]))
        queue = spark.createDataFrame([(1, 5, "PENDING")], f"{KEYS}, processing_status string")
        queue = fill(queue, schemas.COMPLETION_QUEUE)
        tables.replace("completion_queue", queue)
        taken = failing_at(tables, number)
        jobs = Pipeline(tables, now=now, purge_raw=True)
        try:
            jobs.complete(queue, "run")
            failed = False
        except ConnectionError:
            failed = True
            left = tables.read_people("person_input").count()
            done = column(tables.read("completion_queue"), "processing_status") == [("COMPLETED",)]
            # People go only when their batch is delivered.
            assert left == 3 or done
            jobs.complete(queue, "run")
        box = tables.read("outbox").select("client_id", "batch_id", "status", "payload").collect()
        ends.append(
            (
                column(tables.read("completion_queue"), "processing_status", "error_message"),
                column(tables.read("client_batch").select("id", "processed_record_count", F.col("delivery_complete_ts").isNotNull().alias("d")).fillna(-1), "id", "processed_record_count", "d"),
                [(r.batch_id, r.status, json.loads(r.payload)["processed_record_count"]) for r in box],
                tables.changes("outbox").count(),
                column(tables.read_people("person_input"), "batch_id", "record_id"),
            )
        )
        if not failed:
            break
        number += 1
    assert len(taken) >= 6 and all(end == ends[-1] for end in ends)
    assert ends[-1] == ([("COMPLETED", None)], [(5, 2, True), (6, -1, False)], [(5, "READY", 2)], 1, [(6, "c")])


def test_one_failing_type_does_not_undo_the_others(world, monkeypatch):
    t, p = world.tables, world.pipeline
    p.tries = 2
    t.replace_people("person_input", people(world.spark, [(1, 1, "a", "Ann")]))
    t.replace("client_batch", fill(world.spark.createDataFrame([(1, 1, "b1")], "id bigint, client_id bigint, app_batch_id string"), schemas.BATCH))
    ddl = "client_id bigint, batch_id bigint, app_batch_id string, enrichment_type_code string, enrichment_status string"
    ordered = fill(world.spark.createDataFrame([(1, 1, "b1", c, "PENDING") for c in ("GNDRPR", "AGCLPS")], ddl), schemas.ENRICHMENT_STATUS)
    t.replace("enrichment_status", ordered)
    own, calls = p._enrich_age, []

    def broken(code, keys):
        calls.append(code)
        if len(calls) < 4:
            raise RuntimeError("no connection")
        return own(code, keys)

    monkeypatch.setattr(p, "_enrich_age", broken)
    states = lambda: column(t.read("enrichment_status"), "enrichment_type_code", "enrichment_status", "error_message")
    with pytest.raises(EnrichmentError):
        p.start_enrichment(ordered, "r1")
    assert len(calls) == 2 and t.changes("completion_queue").count() == 0
    assert states() == [("AGCLPS", "FAILED", "no connection"), ("GNDRPR", "COMPLETED", None)]
    # Put back by hand instead of repeated by the stream: only what failed comes again.
    p.requeue("enrichment_status", world.spark.createDataFrame([(1, 1)], KEYS), "again")
    again = t.changes("enrichment_status")
    assert column(again, "enrichment_type_code", "enrichment_status") == [("AGCLPS", "PENDING")]
    p.start_enrichment(again, "again")
    assert states() == [("AGCLPS", "COMPLETED", None), ("GNDRPR", "COMPLETED", None)]
    assert t.changes("completion_queue").count() == 1 and t.read_people("age_results_collapsed").count() == 1
