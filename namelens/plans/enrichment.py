"""Enrichment of approved batches: state changes, results, metrics, improvement store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namelens.operators import add_absent, keyed_join, update_matching, upsert
from namelens.plans.approval import STATUS_KEYS
from namelens.plans.baseline import BATCH_KEYS, RECORD_KEYS
from namelens.plans.metrics import METRIC_KEYS

MODEL_VERSION = "v0.01"

# The codes under which clients order enrichments.
GENDER_CODE = "GNDRPR"
AGE_EXPANDED_CODE = "AGEXPD"
AGE_COLLAPSED_CODE = "AGCLPS"


def pending(queue: DataFrame, status_col: str = "processing_status") -> DataFrame:
    """Queue rows that wait for work."""
    return queue.where(F.col(status_col) == "PENDING")


def pending_requests(statuses: DataFrame) -> DataFrame:
    """The distinct enrichments that wait to be started."""
    return (
        pending(statuses, "enrichment_status").select(*STATUS_KEYS, "enrichment_type").distinct()
    )


def advance_status(
    statuses: DataFrame, requests: DataFrame, run_ts: Column, again: bool = False
) -> DataFrame:
    """Requested PENDING rows become RUNNING, with ``again`` FAILED ones too; a first start time is kept."""
    return update_matching(
        statuses,
        requests,
        STATUS_KEYS,
        {
            "enrichment_status": F.lit("RUNNING"),
            "started_ts": F.coalesce("started_ts", run_ts),
            "updated_ts": run_ts,
            "error_message": F.lit(None),
        },
        guard=F.col("enrichment_status").isin("PENDING", *(["FAILED"] if again else [])),
    )


def fail_unsupported(
    statuses: DataFrame, requests: DataFrame, attributes: DataFrame, run_ts: Column
) -> DataFrame:
    """Requested RUNNING rows with a code outside the catalogue become FAILED."""
    codes = attributes.select(F.col("code").alias("enrichment_type_code")).distinct()
    unknown = requests.join(codes, "enrichment_type_code", "left_anti")
    return update_matching(
        statuses,
        unknown,
        STATUS_KEYS,
        {
            "enrichment_status": F.lit("FAILED"),
            "error_message": F.lit("Unsupported enrichment type code."),
            "updated_ts": run_ts,
        },
        guard=F.col("enrichment_status") == "RUNNING",
    )


def fail_running(
    statuses: DataFrame, requests: DataFrame, message: str, run_ts: Column
) -> DataFrame:
    """Requested rows that run and never completed become FAILED with a message."""
    return update_matching(
        statuses,
        requests,
        STATUS_KEYS,
        {
            "enrichment_status": F.lit("FAILED"),
            "error_message": F.lit(message),
            "updated_ts": run_ts,
        },
        guard=(F.col("enrichment_status") == "RUNNING") & F.col("completed_ts").isNull(),
    )


def workable_batches(
    batches: DataFrame,
    statuses: DataFrame | None = None,
    code: str = GENDER_CODE,
    all_open: bool = False,
) -> DataFrame:
    """Batches without a delivery yet whose enrichment runs.

    ``all_open=True`` takes every undelivered batch, approved or not.
    """
    undelivered = batches.where(F.col("delivery_complete_ts").isNull()).select(
        "client_id", F.col("id").alias("batch_id")
    )
    if all_open or statuses is None:
        return undelivered.distinct()
    running = statuses.where(
        (F.col("enrichment_type_code") == code) & (F.col("enrichment_status") == "RUNNING")
    ).select(*BATCH_KEYS)
    return undelivered.join(running, BATCH_KEYS, "left_semi").distinct()


def open_batches(
    people: DataFrame,
    batches: DataFrame,
    statuses: DataFrame | None = None,
    code: str = GENDER_CODE,
    all_open: bool = False,
) -> DataFrame:
    """The workable batches that have people. People are reduced to keys before the join."""
    workable = workable_batches(batches, statuses, code, all_open)
    return workable.join(people.select(*BATCH_KEYS).distinct(), BATCH_KEYS, "left_semi")


def of_batches(people: DataFrame, keys: DataFrame) -> DataFrame:
    """The people of the given batches; a batch of any size stays spread out."""
    return keyed_join(people, keys, BATCH_KEYS, "left_semi")


def to_results(baseline: DataFrame, model_version: str = MODEL_VERSION) -> DataFrame:
    """Baseline people as gender result rows."""
    return baseline.select(
        *RECORD_KEYS,
        F.col("ssa_predicted_gender").alias("predicted_gender"),
        F.col("ssa_reportable_gender").alias("reportable_gender"),
        F.col("ssa_confidence_level").alias("confidence_level"),
        F.col("ssa_max_probability").alias("max_probability"),
        F.col("ssa_probability_gap").alias("probability_gap"),
        F.lit(model_version).alias("model_version"),
        F.col("load_ts").alias("processed_ts"),
        "first_name_missing_flag",
        F.col("ssa_is_rare_name").alias("is_rare_name_flag"),
        F.col("ssa_male_probability").alias("male_probability"),
        F.col("ssa_female_probability").alias("female_probability"),
        F.col("ssa_lookup_match_flag").alias("name_match_found_flag"),
    )


def to_age_results(baseline: DataFrame, model_version: str = MODEL_VERSION) -> DataFrame:
    """Age baseline people as age result rows."""
    return baseline.select(
        *RECORD_KEYS,
        F.col("ssa_predicted_age_bucket").alias("predicted_age_bucket"),
        F.col("ssa_age_confidence_level").alias("confidence_level"),
        F.col("ssa_age_max_probability").alias("max_probability"),
        F.lit(model_version).alias("model_version"),
        F.col("load_ts").alias("processed_ts"),
        "first_name_missing_flag",
        F.col("ssa_age_is_rare_name").alias("is_rare_name_flag"),
        F.col("ssa_age_lookup_match_flag").alias("name_match_found_flag"),
    )


def upsert_results(
    results: DataFrame, baseline: DataFrame, model_version: str = MODEL_VERSION
) -> DataFrame:
    """Result rows after writing the baseline over them, one row per record."""
    return upsert(
        results, to_results(baseline, model_version), RECORD_KEYS, null_keys=False
    )


IMPROVEMENT_COLUMNS = [
    *RECORD_KEYS,
    "first_name_raw",
    "first_name_clean",
    "last_name_raw",
    "last_name_clean",
    "zip_raw",
    "zip5",
    "ssa_male_probability",
    "ssa_female_probability",
    "ssa_confidence_level",
    "ssa_lookup_match_flag",
    "ssa_predicted_gender",
    "ssa_reportable_gender",
]


def to_improvement(
    baseline: DataFrame, clients: DataFrame, model_version: str = MODEL_VERSION
) -> DataFrame:
    """Baseline people of clients that take part in model improvement."""
    members = clients.where(F.col("model_improvement_program_participant")).select(
        F.col("id").alias("client_id")
    )
    return keyed_join(baseline, members, ["client_id"], "left_semi").select(
        *IMPROVEMENT_COLUMNS, F.lit(model_version).alias("model_version")
    )


def upsert_improvement(
    store: DataFrame,
    baseline: DataFrame,
    clients: DataFrame,
    run_ts: Column,
    model_version: str = MODEL_VERSION,
) -> DataFrame:
    """The improvement store after writing the taking-part clients' people over it."""
    return upsert(
        store,
        to_improvement(baseline, clients, model_version),
        RECORD_KEYS,
        insert_literals={"opted_in_data_loaded_ts": run_ts},
        null_keys=False,
    )


def upsert_metrics(summary: DataFrame, metrics: DataFrame, null_safe: bool = True) -> DataFrame:
    """Metric rows after writing new values over them.

    Null labels match each other, so a second run replaces them; with
    ``null_safe=False`` each run adds them again.
    """
    return upsert(
        summary,
        metrics,
        METRIC_KEYS,
        update_cols=["metric_value", "processed_ts"],
        null_safe=null_safe,
    )


def complete_status(
    statuses: DataFrame,
    payloads: DataFrame,
    keys: DataFrame,
    run_ts: Column,
    code: str = GENDER_CODE,
) -> DataFrame:
    """Status rows of the worked-off batches become COMPLETED, with their payload."""
    done = payloads.join(keys.distinct(), BATCH_KEYS, "left_semi").select(
        *BATCH_KEYS,
        F.lit(code).alias("enrichment_type_code"),
        "enrichment_metrics_payload",
    )
    return upsert(
        statuses,
        done,
        [*BATCH_KEYS, "enrichment_type_code"],
        set_literals={
            "enrichment_status": F.lit("COMPLETED"),
            "completed_ts": run_ts,
            "updated_ts": run_ts,
            "error_message": F.lit(None),
        },
        insert=False,
        null_keys=False,
    )


# Why a batch is not enriched: its results could not be told apart.
REPEATED_ID = "A record id occurs more than once in the batch."


def repeated_batches(people: DataFrame) -> DataFrame:
    """The batches in which a record id occurs twice."""
    counts = people.groupBy(*RECORD_KEYS).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > 1).select(*BATCH_KEYS).distinct()


def completion_candidates(
    keys: DataFrame, statuses: DataFrame, require_status: bool = True
) -> DataFrame:
    """Batches none of whose enrichments is still to be completed.

    A batch without any status row is not a candidate unless
    ``require_status=False``.
    """
    unfinished = statuses.where(F.col("enrichment_status") != "COMPLETED").select(*BATCH_KEYS)
    done = keys.select(*BATCH_KEYS).distinct().join(unfinished, BATCH_KEYS, "left_anti")
    if require_status:
        done = done.join(statuses.select(*BATCH_KEYS), BATCH_KEYS, "left_semi")
    return done


def enqueue_completion(queue: DataFrame, candidates: DataFrame, run_ts: Column) -> DataFrame:
    """The completion queue plus the candidates it lacks."""
    return add_absent(
        queue,
        candidates.select(*BATCH_KEYS),
        BATCH_KEYS,
        insert_literals={
            "queued_ts": run_ts,
            "processing_status": F.lit("PENDING"),
            "created_ts": run_ts,
            "updated_ts": run_ts,
        },
        null_keys=False,
    )


def single_batch_results(
    baseline: DataFrame, client_id: int, batch_id: int, model_version: str = MODEL_VERSION
) -> DataFrame:
    """The result rows of one batch."""
    mine = (F.col("client_id") == client_id) & (F.col("batch_id") == batch_id)
    return to_results(baseline.where(mine), model_version)
