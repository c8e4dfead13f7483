"""From uploaded files to sent messages, through the streams."""

from __future__ import annotations

import json
import sys

import pytest
from pyspark.sql import functions as F

from namelens import schemas
from namelens.plans.pipeline import Pipeline
from namelens.plans.refresh import refresh
from namelens.plans.views import register_views
from namelens.sources.tables import Tables
from namelens.streaming import start_ingest, start_queue

# The function of the same name hides the module.
snapshots = sys.modules["namelens.operators.snapshot"]

CONFIG = json.dumps(
    {
        "attributes": [{"code": "GNDRPR", "label": "Gender"}, {"code": "AGCLPS", "label": "Age"}, {"code": None, "label": "x"}],
        "output_fields": [{"field_name": "PREDICTED_GENDER", "sort_order": 1}, {"field_name": "RECORD_ID", "sort_order": None}],
    }
)


def now():
    return F.lit("2026-04-10 12:00:00").cast("timestamp_ntz")


def fill(df, ddl):
    have = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.struct(ddl).fields]
    )


class World:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.tables = Tables(spark, str(root / "tables"), buckets=2)
        self.pipeline = Pipeline(self.tables, now=now)
        counts = [("Ann", "F", 900, 1990), ("Bob", "M", 950, 1950), ("Bob", "F", 50, 1950), ("Kim", "M", 50, 2010), ("Kim", "F", 50, 2010)]
        self.pipeline.load_lookups(spark.createDataFrame(counts, "first_name string, gender string, quantity bigint, year int"))
        clients = spark.createDataFrame([(1, "o1", True), (2, "o2", False)], "id bigint, app_organization_id string, model_improvement_program_participant boolean")
        self.tables.replace("client", fill(clients, schemas.CLIENT))
        codes = spark.createDataFrame([("a", "GNDRPR", "Gender"), ("b", "AGCLPS", "Age"), ("c", "AGEXPD", "Age")], "id string, code string, label string")
        self.tables.replace("enrichment_attribute", fill(codes, schemas.ATTRIBUTE))
        self.sent = []

    def upload(self, org, batch, lines, name="u_people.csv"):
        folder = self.root / "uploads" / f"client_{org}" / f"batch_{batch}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text("\n".join(["RECORD_ID,FIRST_NAME,LAST_NAME,ZIP", *lines]) + "\n")

    def configure(self, org, batch):
        old = self.tables.read("output_configuration")
        new = self.spark.createDataFrame([(org, batch, CONFIG)], "app_organization_id string, app_batch_id string, config_json string")
        self.tables.replace("output_configuration", old.unionByName(fill(new, schemas.OUTPUT_CONFIGURATION)))

    def decide(self, org, batch, status, run):
        row = self.spark.createDataFrame([(org, batch, status, 3)], "app_organization_id string, app_batch_id string, status string, requested_credits bigint")
        self.tables.emit("approval_results", row.withColumn("decision_ts", now()).withColumn("created_ts", now()), run)

    def follow(self, name, handler):
        start_queue(self.tables, name, handler, str(self.root / "checkpoints" / name)).awaitTermination()

    def send(self, messages):
        self.sent += [tuple(r) for r in messages.collect()]
        keys = [c for c in messages.columns if c not in ("payload", "message")]
        return messages.select(*keys, F.lit(200).alias("http_status"), F.lit("").alias("body"), F.lit(None).cast("string").alias("error"))

    def run(self):
        p = self.pipeline
        start_ingest(self.spark, self.tables, str(self.root / "uploads"), str(self.root / "checkpoints" / "ingest"), now=now).awaitTermination()
        self.follow("landing", p.process_files)
        self.follow("approval_results", p.approve)
        self.follow("enrichment_status", p.start_enrichment)
        self.follow("completion_queue", p.complete)
        self.follow("outbox", lambda rows, run: p.deliver(rows, run, self.send))


@pytest.fixture
def world(spark, tmp_path):
    (tmp_path / "uploads").mkdir()
    return World(spark, tmp_path)


def column(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())


def test_upload_to_delivery(world):
    t = world.tables
    world.upload("o1", "b1", ["1,Ann,Lee,98101", "2, BOB ,Lee,1", "3,Kim,,", "4,,Lee,98101", "R-5,Zoe,Lee,98101"])
    world.upload("o2", "b2", ["1,Ann,Lee,98101"])
    world.configure("o1", "b1")
    world.configure("o2", "b2")
    world.run()
    assert column(t.read("client_batch"), "id", "client_id", "app_batch_id", "record_count", "file_name") == [
        (1, 1, "b1", 5, "people.csv"), (2, 2, "b2", 1, "people.csv"),
    ]
    assert t.read_people("person_input").count() == 6
    assert column(t.read("approval_queue"), "app_batch_id", "status") == [("b1", "PENDING"), ("b2", "PENDING")]
    asked = world.pipeline.request_approval(t.changes("approval_queue"), "r", lambda m: m).collect()
    assert sorted(json.loads(r.request)["record_count"] for r in asked) == [1, 5]

    world.decide("o1", "b1", "APPROVED", "d1")
    world.decide("o2", "b2", "DENIED", "d2")
    world.run()
    assert column(t.read("approval_queue"), "app_batch_id", "status") == [("b1", "APPROVED"), ("b2", "DENIED")]
    assert column(t.read("enrichment_status"), "app_batch_id", "enrichment_type_code", "enrichment_status") == [
        ("b1", "AGCLPS", "COMPLETED"), ("b1", "GNDRPR", "COMPLETED"),
    ]
    assert column(t.read_people("gender_results").fillna("-"), "batch_id", "record_id", "predicted_gender", "reportable_gender", "confidence_level") == [
        (1, "1", "F", "F", "HIGH"), (1, "2", "M", "M", "HIGH"), (1, "3", "U", "U", "AMBIGUOUS"), (1, "4", "-", "-", "-"), (1, "R-5", "-", "-", "-"),
    ]
    assert column(t.read_people("age_results_collapsed").fillna("-"), "record_id", "predicted_age_bucket") == [
        ("1", "25_44"), ("2", "65_PLUS"), ("3", "0_24"), ("4", "-"), ("R-5", "-"),
    ]
    assert t.read_people("improvement_store").count() == 5
    assert column(t.read("completion_queue"), "batch_id", "processing_status") == [(1, "COMPLETED")]
    batch = t.read("client_batch").where("id = 1").first()
    assert batch.processed_record_count == 5 and batch.delivery_complete_ts is not None
    assert len(world.sent) == 1
    message = json.loads(world.sent[0][1])
    assert message["batch_id"] == "b1" and message["processed_record_count"] == 5
    assert [m["metric_name"] for m in message["file_analysis"][0]["metrics"]][4] == "Unmatched Records"
    assert column(t.read("outbox"), "id", "status", "attempt_count") == [(1, "SUCCEEDED", 1)]
    # Landing rows of the approved file are gone, those of the other file of the run are not.
    assert column(t.changes("landing").select(F.regexp_extract("storage_file_name", "batch_([^/]+)", 1).alias("b")), "b") == [("b2",)]

    # Nothing new: nothing happens, and nothing is sent again.
    world.run()
    assert len(world.sent) == 1 and t.read_people("gender_results").count() == 5

    # A second drop is handled by itself.
    world.upload("o1", "b3", ["1,Ann,Lee,98101"], "u2_more.csv")
    world.configure("o1", "b3")
    world.decide("o1", "b3", "APPROVED", "d3")
    start_ingest(world.spark, t, str(world.root / "uploads"), str(world.root / "checkpoints" / "ingest"), now=now).awaitTermination()
    world.follow("landing", world.pipeline.process_files)
    world.run()
    assert column(t.read("client_batch"), "id", "app_batch_id") == [(1, "b1"), (2, "b2"), (3, "b3")]
    assert t.read_people("gender_results").count() == 6 and len(world.sent) == 2
    assert t.changes("landing").count() == 1

    key = world.pipeline.prepare_download("o1", "b1", str(world.root / "out"))
    assert key == "downloads/o1/b1/results_b1"
    back = world.spark.read.option("header", True).csv(str(world.root / "out" / key))
    assert back.columns == ["RECORD_ID", "PREDICTED_GENDER"] and back.count() == 5
    assert t.read("client_batch").where("id = 1").first().download_object_key == key
    with pytest.raises(LookupError):
        world.pipeline.prepare_download("o1", "nope", str(world.root / "out"))
    world.sent.clear()
    world.follow("download_ready_queue", lambda rows, run: world.pipeline.announce_downloads(rows, run, world.send))
    assert json.loads(world.sent[0][-1])["object_key"] == key
    assert column(t.read("download_ready_queue"), "app_batch_id", "processing_status") == [("b1", "SUCCEEDED")]
    # A download prepared again waits again and is announced again.
    world.pipeline.prepare_download("o1", "b1", str(world.root / "out"))
    assert column(t.read("download_ready_queue"), "app_batch_id", "processing_status") == [("b1", "PENDING")]
    world.follow("download_ready_queue", lambda rows, run: world.pipeline.announce_downloads(rows, run, world.send))
    assert len(world.sent) == 2

    orders = world.spark.createDataFrame([("o1", "b1", "PENDING"), ("o2", "b2", "PENDING")], "app_organization_id string, app_batch_id string, processing_status string")
    t.emit("download_queue", orders, "q1")
    world.follow("download_queue", lambda rows, run: world.pipeline.prepare_downloads(rows, run, str(world.root / "out")))
    keys = dict(column(t.read("download_ready_queue"), "app_batch_id", "download_object_key"))
    assert set(keys) == {"b1", "b2"}
    for batch, count in (("b1", 5), ("b2", 1)):
        back = world.spark.read.option("header", True).csv(str(world.root / "out" / keys[batch]))
        assert back.columns == ["RECORD_ID", "PREDICTED_GENDER"] and back.count() == count

    single = world.pipeline.prepare_download("o1", "b1", str(world.root / "out"), single_file=True)
    assert single == f"{key}.csv.gz" and (world.root / "out" / single).is_file()

    world.pipeline.release_batch(2, 2)
    assert t.read_people("person_input").where("batch_id = 2").count() == 0
    assert t.read_people("gender_results").where("batch_id = 2").count() == 1


def test_runs_can_be_kept_small(world):
    world.upload("o1", "b1", ["1,Ann,Lee,98101"])
    world.upload("o1", "b2", ["1,Bob,Lee,98101", "2,Ann,,"])
    t = world.tables
    start_ingest(world.spark, t, str(world.root / "uploads"), str(world.root / "checkpoints" / "ingest"), now=now, max_files=1).awaitTermination()
    assert len(list((world.root / "tables" / "changes" / "landing").iterdir())) == 2
    calls = []
    start_queue(t, "landing", lambda rows, run: calls.append((run, rows.count())), str(world.root / "checkpoints" / "l"), max_files=1).awaitTermination()
    assert sum(n for _, n in calls) == 3 and len({run for run, _ in calls}) == len(calls) == 2
    world.follow("landing", world.pipeline.process_files)
    # A new checkpoint lands the files once more, under new run names; the people stay single.
    start_ingest(world.spark, t, str(world.root / "uploads"), str(world.root / "checkpoints" / "again"), now=now).awaitTermination()
    assert t.changes("landing").count() == 6
    world.follow("landing", world.pipeline.process_files)
    assert t.read_people("person_input").count() == 3 and t.read("client_batch").count() == 2


def test_views_for_ad_hoc_sql(world):
    rows = world.spark.createDataFrame(
        [(1, 1, "1", "LOW", 1), (1, 1, "2", "HIGH", 1), (1, 1, "3", None, 0)],
        "client_id bigint, batch_id bigint, record_id string, ssa_confidence_level string, ssa_lookup_match_flag int",
    )
    world.tables.replace_people("improvement_store", fill(rows, schemas.IMPROVEMENT_STORE))
    assert "gender_lookup" in register_views(world.tables)
    sql = world.spark.sql
    assert column(sql("select record_id from vw_model_improvement_low_confidence"), "record_id") == [("1",)]
    report = sql("select * from vw_model_improvement_agg_unmatched_low_quality").first()
    assert (report.total_records, report.unmatched_records, report.matched_low_records) == (3, 1, 1)
    assert sql("select first_name from gender_lookup where first_name = normalize_name(' Ann-')").count() == 1
    assert sql("select normalize_zip5('98101-1'), normalize_zip5('12'), normalize_gender(' male ')").first()[:] == ("98101", None, "M")


def test_jobs_leave_no_snapshots_behind(world, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "scratch_dir", lambda spark: str(tmp_path / "scratch"))
    world.upload("o1", "b1", ["1,Ann,Lee,98101"])
    world.run()
    folder = tmp_path / "scratch" / "namelens"
    assert folder.exists() and not list(folder.iterdir())


def test_a_batch_list_reads_only_its_folders(world):
    t = world.tables
    rows = world.spark.createDataFrame([(1, b, str(b)) for b in range(1, 6)], "client_id bigint, batch_id bigint, record_id string")
    t.replace_people("person_input", fill(rows, schemas.PERSON_INPUT))
    keys = world.spark.createDataFrame([(1, 2), (1, 4), (9, 9)], "client_id bigint, batch_id bigint")
    some = t.read_people("person_input", keys)
    assert column(some, "batch_id", "record_id") == [(2, "2"), (4, "4")]
    assert all("batch_id=2/" in f or "batch_id=4/" in f for f in some.inputFiles())
    # Writing one batch leaves the others alone.
    t.replace_people("person_input", some.where("batch_id = 2").withColumn("record_id", F.lit("new")))
    assert column(t.read_people("person_input"), "batch_id", "record_id") == [(1, "1"), (2, "new"), (3, "3"), (4, "4"), (5, "5")]


def test_a_repeated_run_changes_nothing(world):
    t, p = world.tables, world.pipeline
    world.upload("o1", "b1", ["1,Ann,Lee,98101", "2,Bob,Lee,1"])
    start_ingest(world.spark, t, str(world.root / "uploads"), str(world.root / "checkpoints" / "ingest"), now=now).awaitTermination()
    landed = t.changes("landing")
    for _ in range(2):
        p.process_files(landed, "landing-0")
    assert column(t.read("client_batch"), "id", "app_batch_id") == [(1, "b1")]
    assert t.read_people("person_input").count() == 2
    assert t.read("approval_queue").count() == 1 and t.changes("approval_queue").count() == 1


def test_a_repeated_run_on_dirty_rows(world):
    t, p = world.tables, world.pipeline
    p.purge_raw = True
    # Two files of one batch, rows without an id, and a batch with an id twice.
    world.upload("o1", "b1", ["1,Ann,Lee,98101", ",Bob,Lee,1"])
    world.upload("o1", "b1", [",Kim,Lee,98101"], "u2_more.csv")
    world.upload("o2", "b2", ["1,Ann,,", "1,Bob,,"])
    world.configure("o1", "b1")
    world.configure("o2", "b2")
    start_ingest(world.spark, t, str(world.root / "uploads"), str(world.root / "checkpoints" / "ingest"), now=now).awaitTermination()
    landed = t.changes("landing")
    for _ in range(3):
        p.process_files(landed, "landing-0")
    assert column(t.read("client_batch"), "app_batch_id", "record_count") == [("b1", 3), ("b2", 2)]
    assert t.read_people("person_input").count() == 5
    world.decide("o1", "b1", "APPROVED", "d1")
    world.decide("o2", "b2", "APPROVED", "d2")
    p.approve(t.changes("approval_results"), "approve-0")
    ordered = t.changes("enrichment_status")
    for clock in ("2026-04-10", "2027-01-01"):
        p._now = lambda clock=clock: F.lit(f"{clock} 00:00:00")
        p.start_enrichment(ordered, "enrich-0")
    # One client's repeated id fails its own batch alone.
    statuses = {(r.app_batch_id, r.enrichment_status, r.error_message is None) for r in t.read("enrichment_status").collect()}
    assert statuses == {("b1", "COMPLETED", True), ("b2", "FAILED", False)}
    assert t.read_people("gender_results").count() == 3
    assert column(t.read_people("improvement_store").select(F.year("opted_in_data_loaded_ts").alias("y")).distinct(), "y") == [(2026,)]
    for _ in range(2):
        p.complete(t.changes("completion_queue"), "complete-0")
        batch = t.read("client_batch").where("app_batch_id = 'b1'").first()
        assert batch.processed_record_count == 3
        assert column(t.read("outbox"), "app_batch_id", "status") == [("b1", "READY")]
        assert json.loads(t.read("outbox").first().payload)["processed_record_count"] == 3
    assert t.read_people("person_input").where("batch_id = 1").count() == 0


def test_a_first_load_time_stays(world):
    t, p = world.tables, world.pipeline
    rows = world.spark.createDataFrame([(1, 1, "1", "Ann")], "client_id bigint, batch_id bigint, record_id string, first_name string")
    t.replace_people("person_input", fill(rows, schemas.PERSON_INPUT))
    keys = rows.select("client_id", "batch_id")
    for clock in ("2026-04-10", "2027-01-01"):
        p._now = lambda clock=clock: F.lit(f"{clock} 00:00:00")
        p._enrich_gender("GNDRPR", keys)
    assert t.read_people("improvement_store").first().opted_in_data_loaded_ts.year == 2026
    p.release_batch(1, 1, "v-by-hand")
    assert t.read_people("gender_results").first().model_version == "v-by-hand"


def test_a_held_reader_survives_and_vacuum_goes_by_age(world):
    t = world.tables
    held = t.read("client")
    for _ in range(20):
        t.replace("client", held)
    assert held.count() == 2
    assert t.vacuum(3600) == 0 and held.count() == 2
    assert t.vacuum(0) >= 20 and t.read("client").count() == 2


def test_half_a_run_is_never_listed(world, monkeypatch):
    t = world.tables
    rows = world.spark.createDataFrame([("o1", "b1")], "app_organization_id string, app_batch_id string")
    failing = rows.withColumn("status", F.when(F.col("app_batch_id") == "b1", F.raise_error(F.lit("lost"))).cast("string"))
    with pytest.raises(Exception, match="lost"):
        t.emit("approval_queue", failing, "r1")
    assert t.changes("approval_queue").count() == 0
    t.emit("approval_queue", rows, "r1")
    t.emit("approval_queue", rows, "r1")
    assert t.changes("approval_queue").count() == 1


def test_the_read_is_pruned_at_every_number_of_batches(world):
    t = world.tables
    rows = world.spark.range(30).select(F.lit(1).cast("bigint").alias("client_id"), F.col("id").alias("batch_id"), F.lit("1").alias("record_id"))
    t.replace_people("person_input", fill(rows, schemas.PERSON_INPUT))
    for n in (1, 1001):
        keys = world.spark.range(n).select(F.lit(1).cast("bigint").alias("client_id"), (F.col("id") + 25).alias("batch_id"))
        found = t.read_people("person_input", keys)
        assert {int(f.split("batch_id=")[1].split("/")[0]) for f in found.inputFiles()} == set(range(25, min(30, 25 + n)))


def test_a_failed_enrichment_is_noted(world, monkeypatch):
    t, p = world.tables, world.pipeline
    row = world.spark.createDataFrame([(1, 1, "b1", "GNDRPR", "PENDING"), (1, 1, "b1", "NOPE", "PENDING")], "client_id bigint, batch_id bigint, app_batch_id string, enrichment_type_code string, enrichment_status string")
    statuses = t.replace("enrichment_status", fill(row, schemas.ENRICHMENT_STATUS))

    def broken(code, keys):
        raise RuntimeError("no lookup")

    monkeypatch.setattr(p, "_enrich_gender", broken)
    with pytest.raises(RuntimeError):
        p.start_enrichment(statuses, "r1")
    out = column(t.read("enrichment_status"), "enrichment_type_code", "enrichment_status", "error_message")
    assert out == [("GNDRPR", "FAILED", "no lookup"), ("NOPE", "FAILED", "Unsupported enrichment type code.")]


def test_refresh_follows_the_chain(spark):
    people = spark.createDataFrame([(1, 10, "1", "Ann", None, None), (1, 11, "1", "Bob", None, None)], "client_id bigint, batch_id bigint, record_id string, first_name string, last_name string, zip string").withColumn("load_ts", now())
    counts = spark.createDataFrame([("Ann", "F", 300, 1990)], "first_name string, gender string, quantity bigint, year int")
    sources = {"person_input": people, "name_counts": counts}
    assert column(refresh("gender_baseline", sources), "batch_id", "ssa_lookup_match_flag") == [(10, 1), (11, 0)]
    only = spark.createDataFrame([(1, 11)], "client_id bigint, batch_id bigint")
    assert column(refresh("age_baseline_expanded", sources, only), "batch_id", "ssa_age_lookup_match_flag") == [(11, 0)]
