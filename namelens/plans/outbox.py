"""Book-keeping of message deliveries. Sending itself is left to the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namelens.operators import upsert
from namelens.plans.ingest import APPROVAL_KEYS

# Fixed value: how much of an answer or error is kept.
MAX_ERROR_LENGTH = 5000


def _with_result(outcomes: DataFrame) -> DataFrame:
    """Outcomes (http_status, body, error) judged: 2xx succeeds, all else fails with a text."""
    succeeded = F.coalesce(F.col("http_status").between(200, 299), F.lit(False))
    answer = F.concat(
        F.lit("HTTP "),
        F.col("http_status").cast("string"),
        F.lit(": "),
        F.substring(F.coalesce("body", F.lit("")), 1, MAX_ERROR_LENGTH),
    )
    failure = F.coalesce(answer, F.substring("error", 1, MAX_ERROR_LENGTH))
    return outcomes.select(
        "*",
        F.when(succeeded, "SUCCEEDED").otherwise("FAILED").alias("_status"),
        F.when(~succeeded, failure).alias("_message"),
    )


def _apply(
    queue: DataFrame, outcomes: DataFrame, keys: Sequence[str], sets: dict[str, Column]
) -> DataFrame:
    judged = _with_result(outcomes).select(*keys, "_status", "_message")
    widened = queue.withColumn("_status", F.lit(None).cast("string")).withColumn(
        "_message", F.lit(None).cast("string")
    )
    merged = upsert(
        widened, judged, keys, set_literals=sets, insert=False, null_keys=False
    )
    return merged.drop("_status", "_message")


def apply_delivery_outcomes(outbox: DataFrame, outcomes: DataFrame, run_ts: Column) -> DataFrame:
    """The outbox after delivery attempts: outcomes are (id, http_status, body, error)."""
    done = F.col("s._status") == "SUCCEEDED"
    return _apply(
        outbox,
        outcomes,
        ["id"],
        {
            "status": F.col("s._status"),
            "attempt_count": F.coalesce(F.col("t.attempt_count"), F.lit(0)) + 1,
            "last_attempt_ts": run_ts,
            "last_error": F.col("s._message"),
            "processed_ts": F.when(done, run_ts).otherwise(F.col("t.processed_ts")),
        },
    )


def apply_download_outcomes(queue: DataFrame, outcomes: DataFrame, run_ts: Column) -> DataFrame:
    """The ready queue after announcing downloads; keyed by organization and batch.

    The start time is set on rows that were still pending.
    """
    done = F.col("s._status") == "SUCCEEDED"
    waiting = F.col("t.processing_status") == "PENDING"
    return _apply(
        queue,
        outcomes,
        APPROVAL_KEYS,
        {
            "processing_status": F.col("s._status"),
            "processing_started_ts": F.when(waiting, run_ts).otherwise(
                F.col("t.processing_started_ts")
            ),
            "processed_ts": F.when(done, run_ts).otherwise(F.col("t.processed_ts")),
            "updated_ts": run_ts,
            "error_message": F.col("s._message"),
        },
    )


def delivery_totals(outcomes: DataFrame) -> DataFrame:
    """How many deliveries were tried, succeeded and failed."""
    return _with_result(outcomes).agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col("_status") == "SUCCEEDED").alias("succeeded"),
        F.count_if(F.col("_status") == "FAILED").alias("failed"),
    )


def download_messages(queue: DataFrame) -> DataFrame:
    """The JSON object that announces each prepared download."""
    return queue.select(
        *APPROVAL_KEYS,
        F.to_json(
            F.struct(
                F.col("app_organization_id").alias("organization_id"),
                F.col("app_batch_id").alias("batch_id"),
                F.col("download_object_key").alias("object_key"),
                F.col("download_status").alias("status"),
            )
        ).alias("message"),
    )
