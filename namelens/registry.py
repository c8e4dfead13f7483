"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namelens import schemas
from namelens.bindings import bind
from namelens.functions import (
    normalize_gender,
    normalize_name,
    normalize_zip5,
    parse_upload_path,
    record_order,
    register_functions,
)
from namelens.operators import keyed_join, ranked, scratch_path, with_new_ids
from namelens.plans import (
    approval,
    baseline,
    completion,
    download,
    enrichment,
    evaluate,
    ingest,
    lookups,
    metrics,
    outbox,
)
from namelens.sources.export import export_batches, read_export
from namelens.plans.pipeline import Pipeline
from namelens.sources.files import safe_cast, sample_client_file
from namelens.sources.tables import Tables
from namelens.streaming import start_ingest, start_queue

VERSION = enrichment.MODEL_VERSION
RUN_TIME = "2026-04-10 15:37:39"
SAMPLE_SIZE = 1000

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def run_ts() -> Column:
    return F.lit(RUN_TIME).cast("timestamp_ntz")


def comparable(df: DataFrame) -> DataFrame:
    """Plain types for the comparison: exact decimals as doubles, times as text."""
    out = []
    for field in df.schema.fields:
        c, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.DecimalType):
            c = c.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c.cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DateType):
            c = c.cast("string")
        out.append(c.alias(field.name))
    return df.select(*out)


class Inputs:
    """The bound tables of one folder and the stages made from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return bind(self.spark, self.sf_dir, name)

    @property
    def stage(self) -> DataFrame:
        return lookups.name_count_stage(self.ssa_raw)

    @property
    def voters(self) -> DataFrame:
        return lookups.voter_stage(self.voter_raw)

    @property
    def clean(self) -> DataFrame:
        return baseline.person_clean(self.person_input)

    @property
    def counts(self) -> DataFrame:
        return lookups.valid_name_counts(self.ssa_raw)

    @property
    def genders(self) -> DataFrame:
        return lookups.gender_lookup(self.counts, cleaned=False)

    def ages(self, scheme: lookups.AgeScheme) -> DataFrame:
        return lookups.age_lookup(self.counts, scheme, cleaned=False)

    @property
    def people(self) -> DataFrame:
        return baseline.gender_baseline(self.clean, self.genders)

    @property
    def improvement(self) -> DataFrame:
        return enrichment.to_improvement(self.people, self.client)

    @property
    def files(self) -> DataFrame:
        return ingest.landed_files(self.landing)

    @property
    def known_batches(self) -> DataFrame:
        """Batches registered before the landing rows came in."""
        return self.client_batch.where(F.col("delivery_complete_ts").isNotNull())

    @property
    def decisions(self) -> DataFrame:
        return approval.latest_approval(self.approval_results, "seq")

    @property
    def old_results(self) -> DataFrame:
        return self.old_records.select(
            *baseline.RECORD_KEYS,
            F.lit("U").alias("predicted_gender"),
            F.lit("U").alias("reportable_gender"),
            F.lit("LOW").alias("confidence_level"),
            F.lit(0.5).cast("decimal(10,6)").alias("max_probability"),
            F.lit(0).cast("decimal(10,6)").alias("probability_gap"),
            F.lit("v0.00").alias("model_version"),
            F.lit("2026-01-01 00:00:00").cast("timestamp_ntz").alias("processed_ts"),
            F.lit(0).alias("first_name_missing_flag"),
            F.lit(0).alias("is_rare_name_flag"),
            F.lit(0.5).cast("decimal(10,6)").alias("male_probability"),
            F.lit(0.5).cast("decimal(10,6)").alias("female_probability"),
            F.lit(1).alias("name_match_found_flag"),
        )

    @property
    def old_store(self) -> DataFrame:
        have = {
            "ssa_confidence_level": F.lit("LOW"),
            "model_version": F.lit("v0.00"),
            "opted_in_data_loaded_ts": F.lit("2026-01-01 00:00:00"),
        }
        return self.old_records.select(
            *[
                (F.col(f.name) if f.name in baseline.RECORD_KEYS else have.get(f.name, F.lit(None)))
                .cast(f.dataType)
                .alias(f.name)
                for f in schemas.struct(schemas.IMPROVEMENT_STORE).fields
            ]
        )


def query(make: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[make.__name__] = lambda spark, sf_dir: comparable(make(Inputs(spark, sf_dir)))
    return make


# Sources and sinks


@query
def landing_rows(i: Inputs) -> DataFrame:
    """Uploads written as CSV, landed by a stream and counted per batch."""
    parts = parse_upload_path("storage_file_name")
    uploads = i.landing.select(
        "record_id",
        "first_name",
        "last_name",
        "zip",
        F.concat(F.lit("client_"), F.coalesce(parts["app_organization_id"], F.lit("none"))).alias("org"),
        F.concat(F.lit("batch_"), parts["app_batch_id"]).alias("batch"),
    )
    root = scratch_path(i.spark, "landing")
    uploads.hint("rebalance", "org", "batch").write.partitionBy("org", "batch").option(
        "header", True
    ).csv(f"{root}/uploads")
    tables = Tables(i.spark, f"{root}/tables")
    start_ingest(
        i.spark, tables, f"{root}/uploads", f"{root}/checkpoint", now=run_ts
    ).awaitTermination()
    landed = tables.changes("landing")
    files = (
        ingest.parse_landing(landed)
        .groupBy("app_organization_id", "app_batch_id", "storage_file_name")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("file_record_row_number").alias("first"),
            F.max("file_record_row_number").alias("last"),
            F.sum("file_record_row_number").alias("numbers"),
            F.sum(F.col("zip").cast("bigint")).alias("zips"),
            F.sum(F.length("first_name") + F.length("last_name")).alias("letters"),
        )
    )
    n = F.col("n")
    in_order = (F.col("first") == 1) & (F.col("last") == n) & (F.col("numbers") * 2 == n * (n + 1))
    return files.groupBy("app_organization_id", "app_batch_id").agg(
        F.sum("n").alias("records"),
        F.bool_and(in_order).alias("numbered"),
        F.sum("zips").alias("zips"),
        F.sum("letters").alias("letters"),
    )


@query
def safe_cast_load(i: Inputs) -> DataFrame:
    kinds = {name: schemas.VOTER_FIELDS[name] for name in i.voter_text.columns}
    return safe_cast(i.voter_text, kinds)


@query
def export_projection(i: Inputs) -> DataFrame:
    """All batches written as gzipped CSV and read back as text."""
    keys = ingest.batch_keys(i.client, i.client_batch)
    rows = keyed_join(_download(i), keys, baseline.BATCH_KEYS, "inner")
    path = scratch_path(i.spark, "export")
    export_batches(rows, path)
    back = read_export(i.spark, path)
    return back.select(*[F.col(c).alias(c.lower()) for c in back.columns])


@query
def sample_client_file_(i: Inputs) -> DataFrame:
    return sample_client_file(i.voters, SAMPLE_SIZE)


QUERIES["sample_client_file"] = QUERIES.pop("sample_client_file_")


@query
def append_stream(i: Inputs) -> DataFrame:
    """Queue rows inserted in two drops and followed by a stream that is stopped in between.

    Every row comes once, though the table itself is rewritten after each drop.
    """
    root = scratch_path(i.spark, "stream")
    tables = Tables(i.spark, f"{root}/tables")
    seen = f"{root}/seen"

    def follow() -> None:
        handler = lambda rows, run: rows.write.parquet(f"{seen}/{run}")
        start_queue(tables, "enrichment_status", handler, f"{root}/checkpoint").awaitTermination()

    rows = i.enrichment_status
    for number, drop in enumerate((F.col("started_ts").isNull(), F.col("started_ts").isNotNull())):
        tables.emit("enrichment_status", rows.where(drop), f"drop-{number}")
        tables.replace("enrichment_status", rows.withColumn("updated_ts", run_ts()))
        follow()
    follow()
    return (
        i.spark.read.schema(rows.schema)
        .option("recursiveFileLookup", True)
        .parquet(seen)
        .groupBy("client_id", "batch_id", "enrichment_type_code", "enrichment_status", "updated_ts")
        .agg(F.count(F.lit(1)).alias("times_seen"))
    )


@query
def upload_to_results(i: Inputs) -> DataFrame:
    """All landed files taken through registration, approval, enrichment and completion."""
    tables = Tables(i.spark, scratch_path(i.spark, "tables"))
    jobs = Pipeline(tables, VERSION, run_ts)
    jobs.load_lookups(i.ssa_raw)
    tables.replace("client", _as(i.client, schemas.CLIENT))
    tables.replace("enrichment_attribute", _as(i.attribute, schemas.ATTRIBUTE))
    tables.emit("landing", i.landing, "uploads")
    jobs.process_files(tables.changes("landing"), "uploads")
    asked = tables.changes("approval_queue").select(*ingest.APPROVAL_KEYS)
    ordered = '{"attributes":[{"code":"GNDRPR","label":"Gender"}]}'
    tables.replace(
        "output_configuration",
        _as(asked.withColumn("config_json", F.lit(ordered)), schemas.OUTPUT_CONFIGURATION),
    )
    tables.emit(
        "approval_results",
        asked.select("*", F.lit("APPROVED").alias("status"), run_ts().alias("decision_ts")),
        "decisions",
    )
    jobs.approve(tables.changes("approval_results"), "decisions")
    jobs.start_enrichment(tables.changes("enrichment_status"), "decisions")
    jobs.complete(tables.changes("completion_queue"), "done")
    batches = tables.read("client_batch").select(
        "client_id",
        F.col("id").alias("batch_id"),
        "app_batch_id",
        "processed_record_count",
        "delivery_complete_ts",
    )
    messages = tables.read("outbox").select(*baseline.BATCH_KEYS, F.col("status").alias("message_status"))
    return (
        tables.read_people("gender_results")
        .join(batches, baseline.BATCH_KEYS)
        .join(messages, baseline.BATCH_KEYS)
        .drop("batch_id")
    )


def _as(df: DataFrame, ddl: str) -> DataFrame:
    """``df`` in the columns of a table; columns it lacks are null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.struct(ddl).fields
        ]
    )


# Functions


@query
def normalize_name_(i: Inputs) -> DataFrame:
    return i.person_input.select(
        *baseline.RECORD_KEYS,
        normalize_name("first_name").alias("first_name_clean"),
        normalize_name("last_name").alias("last_name_clean"),
        normalize_name("first_name", unicode=True).alias("first_name_letters"),
    )


@query
def normalize_zip5_(i: Inputs) -> DataFrame:
    return i.voter_raw.select(
        "state_voter_id",
        normalize_zip5("registration_zip_code").alias("registration_zip5"),
        normalize_zip5("mailing_zip_code").alias("mailing_zip5"),
    )


@query
def normalize_gender_(i: Inputs) -> DataFrame:
    return i.voter_raw.select("state_voter_id", normalize_gender("gender").alias("gender_clean"))


for _name in ("normalize_name", "normalize_zip5", "normalize_gender"):
    QUERIES[_name] = QUERIES.pop(f"{_name}_")


@query
def sql_functions(i: Inputs) -> DataFrame:
    """The cleaning functions called from SQL text."""
    register_functions(i.spark)
    i.voter_raw.createOrReplaceTempView("namelens_voter_raw")
    return i.spark.sql(
        "select state_voter_id, normalize_name(first_name) as first_name,"
        " normalize_zip5(registration_zip_code) as zip5, normalize_gender(gender) as gender"
        " from namelens_voter_raw"
    )


@query
def parse_upload_path_(i: Inputs) -> DataFrame:
    return ingest.parse_landing(i.landing).select(
        "record_id", *parse_upload_path("storage_file_name")
    )


QUERIES["parse_upload_path"] = QUERIES.pop("parse_upload_path_")


@query
def name_search(i: Inputs) -> DataFrame:
    return evaluate.name_search(i.genders, "%RING%")


# Derived tables


@query
def ssa_stage(i: Inputs) -> DataFrame:
    return i.stage


@query
def person_clean(i: Inputs) -> DataFrame:
    return i.clean


@query
def voter_stage(i: Inputs) -> DataFrame:
    return i.voters


@query
def gender_lookup(i: Inputs) -> DataFrame:
    return i.genders


@query
def voter_gender_lookup(i: Inputs) -> DataFrame:
    return lookups.voter_gender_lookup(i.voter_raw, cleaned=False)


@query
def age_lookup_generic(i: Inputs) -> DataFrame:
    return i.ages(lookups.GENERIC_AGES)


@query
def age_lookup_specific(i: Inputs) -> DataFrame:
    return i.ages(lookups.SPECIFIC_AGES)


@query
def gender_baseline(i: Inputs) -> DataFrame:
    return i.people


@query
def age_baseline_expanded(i: Inputs) -> DataFrame:
    return baseline.age_baseline(i.clean, i.ages(lookups.SPECIFIC_AGES))


@query
def age_baseline_collapsed(i: Inputs) -> DataFrame:
    return baseline.age_baseline(i.clean, i.ages(lookups.GENERIC_AGES))


@query
def low_confidence(i: Inputs) -> DataFrame:
    return baseline.low_confidence(i.improvement)


@query
def unmatched_report(i: Inputs) -> DataFrame:
    return baseline.unmatched_report(i.improvement)


@query
def batch_gender_summary(i: Inputs) -> DataFrame:
    return baseline.batch_gender_summary(i.people, VERSION)


# Metrics, payloads, evaluation


@query
def batch_metrics(i: Inputs) -> DataFrame:
    return metrics.batch_metrics(i.people, VERSION)


@query
def batch_metrics_all_rows(i: Inputs) -> DataFrame:
    return metrics.batch_metrics(i.people, VERSION, matched_only=False)


@query
def metrics_payload(i: Inputs) -> DataFrame:
    return metrics.metrics_payload(metrics.batch_metrics(i.people, VERSION), VERSION)


@query
def metrics_delivery_payload(i: Inputs) -> DataFrame:
    summary = metrics.batch_metrics(i.people, VERSION, matched_only=False)
    keys = enrichment.open_batches(i.person_input, i.client_batch, all_open=True)
    return completion.metrics_delivery_payload(
        keys, i.client_batch, i.client, metrics.metric_blocks(summary), VERSION, run_ts()
    )


def _request_keys(i: Inputs) -> DataFrame:
    return i.request_batch.select("client_id", F.col("id").alias("batch_id"))


def _messages(i: Inputs) -> DataFrame:
    return completion.delivery_payload(
        _request_keys(i), i.request_batch, i.request_client, i.enrichment_status, run_ts()
    )


@query
def delivery_payload(i: Inputs) -> DataFrame:
    return _messages(i)


@query
def config_select_list(i: Inputs) -> DataFrame:
    return download.config_select_list(i.output_config)


@query
def gender_accuracy(i: Inputs) -> DataFrame:
    return evaluate.gender_accuracy(i.genders, i.voter_raw, cleaned=False)


@query
def gender_accuracy_by_bucket(i: Inputs) -> DataFrame:
    return evaluate.gender_accuracy(i.genders, i.voter_raw, by_bucket=True, cleaned=False)


def _age_accuracy(i: Inputs, scheme: lookups.AgeScheme, by_bucket: bool = False) -> DataFrame:
    return evaluate.age_accuracy(
        i.ages(scheme), i.voter_raw, scheme, by_bucket=by_bucket, cleaned=False
    )


@query
def age_accuracy_specific(i: Inputs) -> DataFrame:
    return _age_accuracy(i, lookups.SPECIFIC_AGES)


@query
def age_accuracy_generic(i: Inputs) -> DataFrame:
    return _age_accuracy(i, lookups.GENERIC_AGES)


@query
def age_accuracy_by_bucket(i: Inputs) -> DataFrame:
    return _age_accuracy(i, lookups.GENERIC_AGES, by_bucket=True)


@query
def age_accuracy_by_bucket_specific(i: Inputs) -> DataFrame:
    return _age_accuracy(i, lookups.SPECIFIC_AGES, by_bucket=True)


@query
def prob_histogram(i: Inputs) -> DataFrame:
    return evaluate.prob_histogram(i.ages(lookups.SPECIFIC_AGES))


@query
def confidence_distribution(i: Inputs) -> DataFrame:
    return baseline.confidence_distribution(i.people)


@query
def non_high_records(i: Inputs) -> DataFrame:
    return baseline.non_high_records(i.people)


@query
def batch_record_counts(i: Inputs) -> DataFrame:
    counts = baseline.batch_record_counts(i.person_input)
    batches = i.client_batch.select("client_id", F.col("id").alias("batch_id"), "app_batch_id")
    return batches.join(counts, baseline.BATCH_KEYS)


@query
def approval_requests(i: Inputs) -> DataFrame:
    return approval.approval_requests(i.approval_queue, i.request_batch)


# Queues and keyed writes


@query
def pending_queue_rows(i: Inputs) -> DataFrame:
    return enrichment.pending_requests(i.enrichment_status)


@query
def register_batches(i: Inputs) -> DataFrame:
    known = i.known_batches
    start = known.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    new = ingest.register_batches(i.files, i.client, known)
    return with_new_ids(new, [F.col("storage_file_name")], start)


@query
def raw_insert_absent(i: Inputs) -> DataFrame:
    return ingest.raw_rows(i.landing, i.files, i.client, i.client_batch, i.old_records)


@query
def enqueue_approval(i: Inputs) -> DataFrame:
    queued = ingest.batch_keys(i.client, i.known_batches).select(
        *ingest.APPROVAL_KEYS,
        "batch_id",
        F.lit("APPROVED").alias("status"),
        F.lit("2026-04-01 00:00:00").cast("timestamp_ntz").alias("created_ts"),
        F.lit("2026-04-01 00:00:00").cast("timestamp_ntz").alias("updated_ts"),
    )
    entries = ingest.approval_entries(i.files, i.client, i.client_batch)
    return ingest.enqueue_approval(queued, entries, run_ts())


@query
def latest_approval(i: Inputs) -> DataFrame:
    return i.decisions


@query
def apply_decisions(i: Inputs) -> DataFrame:
    return approval.apply_decisions(i.approval_queue, i.decisions, run_ts())


@query
def enrichment_requests(i: Inputs) -> DataFrame:
    return approval.enrichment_requests(
        i.decisions, i.request_client, i.request_batch, i.output_config, i.enrichment_status
    )


@query
def purge_approved_landing(i: Inputs) -> DataFrame:
    return approval.purge_approved_landing(
        i.request_landing, i.decisions, i.request_client, i.request_batch
    )


@query
def advance_status(i: Inputs) -> DataFrame:
    statuses = i.enrichment_status
    return enrichment.advance_status(statuses, enrichment.pending_requests(statuses), run_ts())


@query
def fail_unsupported(i: Inputs) -> DataFrame:
    statuses = i.enrichment_status
    requests = enrichment.pending_requests(statuses)
    running = enrichment.advance_status(statuses, requests, run_ts())
    return enrichment.fail_unsupported(running, requests, i.attribute, run_ts())


@query
def open_batches(i: Inputs) -> DataFrame:
    """Undelivered batches and, of their people, how many there are."""
    keys = enrichment.open_batches(i.person_input, i.client_batch, all_open=True)
    return baseline.batch_record_counts(enrichment.of_batches(i.person_input, keys))


@query
def upsert_results(i: Inputs) -> DataFrame:
    return enrichment.upsert_results(i.old_results, i.people, VERSION)


@query
def model_improvement_upsert(i: Inputs) -> DataFrame:
    return enrichment.upsert_improvement(i.old_store, i.people, i.client, run_ts(), VERSION)


@query
def metrics_upsert(i: Inputs) -> DataFrame:
    people = i.people
    older = metrics.batch_metrics(people, VERSION, matched_only=False)
    return enrichment.upsert_metrics(older, metrics.batch_metrics(people, VERSION))


@query
def complete_status(i: Inputs) -> DataFrame:
    statuses = i.enrichment_status
    payloads = i.request_batch.select(
        "client_id",
        F.col("id").alias("batch_id"),
        F.concat(F.lit('{"records":'), F.coalesce("record_count", F.lit(0)).cast("string"), F.lit("}"))
        .alias("enrichment_metrics_payload"),
    )
    keys = enrichment.pending_requests(statuses).select(*baseline.BATCH_KEYS)
    return enrichment.complete_status(statuses, payloads, keys, run_ts())


@query
def completion_candidates(i: Inputs) -> DataFrame:
    return enrichment.completion_candidates(_request_keys(i), i.enrichment_status)


@query
def complete_batches(i: Inputs) -> DataFrame:
    keys = enrichment.completion_candidates(_request_keys(i), i.enrichment_status)
    return completion.complete_batches(i.request_batch, keys, i.request_people, run_ts())


@query
def outbox_upsert(i: Inputs) -> DataFrame:
    return completion.outbox_upsert(i.outbox, _messages(i)).drop("id")


@query
def purge_delivered(i: Inputs) -> DataFrame:
    keys = i.known_batches.select("client_id", F.col("id").alias("batch_id"))
    return completion.purge_delivered(i.person_input, keys)


@query
def single_batch_results(i: Inputs) -> DataFrame:
    """The largest batch, in record order."""
    largest = (
        baseline.batch_record_counts(i.person_input)
        .orderBy(F.desc("record_count"), "batch_id")
        .first()
    )
    rows = enrichment.single_batch_results(i.people, largest["client_id"], largest["batch_id"])
    return ranked(rows, record_order("record_id"), name="place")


def _download(i: Inputs) -> DataFrame:
    keys = enrichment.open_batches(i.person_input, i.client_batch, all_open=True)
    results = enrichment.to_results(enrichment.of_batches(i.people, keys))
    return download.download_rows(i.person_input, results)


@query
def download_rows(i: Inputs) -> DataFrame:
    return _download(i)


@query
def pending_downloads(i: Inputs) -> DataFrame:
    return download.pending_downloads(
        i.download_queue, i.client, i.client_batch, i.person_input, enrichment.to_results(i.people)
    )


@query
def download_ready_upsert(i: Inputs) -> DataFrame:
    keys = ingest.batch_keys(i.request_client, i.request_batch)
    return download.download_ready_upsert(i.ready_queue, download.ready_entries(keys), run_ts())


@query
def apply_delivery_outcomes(i: Inputs) -> DataFrame:
    return outbox.apply_delivery_outcomes(i.outbox, i.delivery_outcomes, run_ts())


@query
def delivery_totals(i: Inputs) -> DataFrame:
    return outbox.delivery_totals(i.delivery_outcomes)


# Order and windows


@query
def rarest_name_per_year(i: Inputs) -> DataFrame:
    return evaluate.rarest_name_per_year(i.ssa_raw)


@query
def record_order_(i: Inputs) -> DataFrame:
    """The place of each record in its batch: numeric ids by value, then the others."""
    rows = i.person_input.select(*baseline.RECORD_KEYS)
    return ranked(rows, record_order("record_id"), by=baseline.BATCH_KEYS, name="place")


QUERIES["record_order"] = QUERIES.pop("record_order_")


@query
def name_history(i: Inputs) -> DataFrame:
    return evaluate.name_history(i.stage, "small%")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People cleaned, joined to the gender lookup and counted per confidence level."""
    return comparable(baseline.confidence_distribution(Inputs(spark, sf_dir).people))


# Registers its queries here; it needs what is defined above.
from namelens import job_queries  # noqa: E402, F401
