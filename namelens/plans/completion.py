"""Closing of enriched batches and the delivery messages about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namelens.operators import delete_matching, update_matching, upsert
from namelens.plans.baseline import BATCH_KEYS, batch_record_counts

# Names used in the delivery messages.
EVENT_TYPE = "DELIVERY_STATUS_UPDATED"
READY = "READY"


def start_completion(
    queue: DataFrame, keys: DataFrame, run_ts: Column, again: bool = False
) -> DataFrame:
    """Waiting batches become RUNNING; with ``again`` those that failed as well."""
    return update_matching(
        queue,
        keys,
        BATCH_KEYS,
        {
            "processing_status": F.lit("RUNNING"),
            "processing_started_ts": F.coalesce("processing_started_ts", run_ts),
            "updated_ts": run_ts,
            "error_message": F.lit(None),
        },
        guard=F.col("processing_status").isin("PENDING", *(["FAILED"] if again else [])),
    )


def finish_completion(queue: DataFrame, keys: DataFrame, run_ts: Column) -> DataFrame:
    return update_matching(
        queue,
        keys,
        BATCH_KEYS,
        {
            "processing_status": F.lit("COMPLETED"),
            "processed_ts": run_ts,
            "updated_ts": run_ts,
            "error_message": F.lit(None),
        },
        guard=F.col("processing_status") == "RUNNING",
    )


def fail_completion(queue: DataFrame, keys: DataFrame, message: str, run_ts: Column) -> DataFrame:
    return update_matching(
        queue,
        keys,
        BATCH_KEYS,
        {
            "processing_status": F.lit("FAILED"),
            "error_message": F.lit(message),
            "updated_ts": run_ts,
        },
        guard=F.col("processing_status") == "RUNNING",
    )


def complete_batches(
    batches: DataFrame,
    keys: DataFrame,
    raw: DataFrame,
    run_ts: Column,
    close_empty: bool = True,
) -> DataFrame:
    """Batches with delivery time and record count set.

    A batch whose raw people are gone is closed with a count of 0;
    ``close_empty=False`` leaves it open. People are counted per batch before
    the join.
    """
    return close_batches(batches, batch_counts(keys, raw, close_empty), run_ts)


def delivered(keys: DataFrame, queue: DataFrame, batches: DataFrame) -> DataFrame:
    """Of some batches those that are completed and have a delivery time: their raw people may go."""
    done = queue.where(F.col("processing_status") == "COMPLETED").select(*BATCH_KEYS)
    closed = batches.where(F.col("delivery_complete_ts").isNotNull()).select("client_id", F.col("id").alias("batch_id"))
    keys = keys.select(*BATCH_KEYS).distinct()
    return keys.join(done, BATCH_KEYS, "left_semi").join(closed, BATCH_KEYS, "left_semi")


def batch_counts(keys: DataFrame, raw: DataFrame, close_empty: bool = True) -> DataFrame:
    """The number of people of each batch."""
    keys = keys.select(*BATCH_KEYS).distinct()
    counts = batch_record_counts(raw)
    return keys.join(counts, BATCH_KEYS, "left" if close_empty else "inner").select(
        *BATCH_KEYS, F.coalesce("record_count", F.lit(0)).cast("bigint").alias("processed_record_count")
    )


def close_batches(batches: DataFrame, counted: DataFrame, run_ts: Column) -> DataFrame:
    """Batches with delivery time and the counted number of records set."""
    closed = counted.select("client_id", F.col("batch_id").alias("id"), "processed_record_count")
    return upsert(
        batches,
        closed,
        ["client_id", "id"],
        set_literals={"delivery_complete_ts": run_ts},
        insert=False,
        null_keys=False,
    )


def _time_text(run_ts: Column) -> Column:
    return F.date_format(run_ts.cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSS xx")


def _message(fields: list[Column], analysis: Column, last: list[Column]) -> Column:
    """A JSON object: ``fields``, then ``file_analysis``, then ``last``; null fields are left out."""
    head, tail = F.to_json(F.struct(*fields)), F.to_json(F.struct(*last))
    head = F.regexp_replace(head, r"\}$", "")
    tail = F.regexp_replace(tail, r"^\{", "")
    return F.concat(
        head,
        F.lit(',"file_analysis":['),
        F.coalesce(analysis, F.lit("")),
        F.when(tail == "}", "]}").otherwise(F.concat(F.lit("],"), tail)),
    )


def _addressed(keys: DataFrame, batches: DataFrame, clients: DataFrame) -> DataFrame:
    owners = clients.select(F.col("id").alias("client_id"), "app_organization_id")
    named = batches.select(
        "client_id", F.col("id").alias("batch_id"), "app_batch_id", "processed_record_count"
    )
    return (
        keys.select(*BATCH_KEYS).distinct().join(named, BATCH_KEYS).join(owners, "client_id")
    )


def _as_outbox_rows(messages: DataFrame, payload: Column, run_ts: Column) -> DataFrame:
    return messages.select(
        *BATCH_KEYS,
        "app_batch_id",
        "app_organization_id",
        payload.alias("payload"),
        F.lit(EVENT_TYPE).alias("event_type"),
        F.lit(READY).alias("status"),
        F.lit(0).alias("attempt_count"),
        run_ts.alias("created_ts"),
    )


def delivery_payload(
    keys: DataFrame,
    batches: DataFrame,
    clients: DataFrame,
    statuses: DataFrame,
    run_ts: Column,
) -> DataFrame:
    """One message per batch with the analyses of all its completed enrichments.

    Analyses are in order of their type code; a batch has at most one per code.
    """
    text = F.col("enrichment_metrics_payload")
    blocks = (
        statuses.where((F.col("enrichment_status") == "COMPLETED") & text.isNotNull())
        .join(keys.select(*BATCH_KEYS).distinct(), BATCH_KEYS, "left_semi")
        .withColumn("block", F.to_json(F.try_parse_json(text)))
        .where(F.col("block").isNotNull())
        .groupBy(*BATCH_KEYS)
        .agg(
            F.array_sort(F.collect_list(F.struct("enrichment_type_code", "block"))).alias("blocks")
        )
        .select(
            *BATCH_KEYS,
            F.array_join(F.transform("blocks", lambda b: b["block"]), ",").alias("analysis"),
        )
    )
    messages = _addressed(keys, batches, clients).join(blocks, BATCH_KEYS, "left")
    payload = _message(
        [
            F.col("app_batch_id").alias("batch_id"),
            F.lit(READY).alias("delivery_status"),
            _time_text(run_ts).alias("delivery_status_updated_at"),
        ],
        F.col("analysis"),
        [F.col("app_organization_id").alias("organization_id"), F.col("processed_record_count")],
    )
    return _as_outbox_rows(messages, payload, run_ts)


def metrics_delivery_payload(
    keys: DataFrame,
    batches: DataFrame,
    clients: DataFrame,
    payloads: DataFrame,
    model_version: str,
    run_ts: Column,
) -> DataFrame:
    """The older message: the gender metrics of one model version, without a record count."""
    blocks = payloads.where(F.col("model_version") == model_version).select(
        *BATCH_KEYS, F.col("enrichment_metrics_payload").alias("analysis")
    )
    messages = _addressed(keys, batches, clients).join(blocks, BATCH_KEYS, "left")
    payload = _message(
        [
            F.col("app_batch_id").alias("batch_id"),
            F.lit(READY).alias("delivery_status"),
            _time_text(run_ts).alias("delivery_status_updated_at"),
        ],
        F.col("analysis"),
        [F.col("app_organization_id").alias("organization_id")],
    )
    return _as_outbox_rows(messages, payload, run_ts)


OUTBOX_KEYS = [*BATCH_KEYS, "event_type"]


def outbox_upsert(outbox: DataFrame, messages: DataFrame) -> DataFrame:
    """Unsent messages are refreshed in place; a sent one is followed by a new row.

    New rows have no id yet.
    """
    return upsert(
        outbox,
        messages,
        OUTBOX_KEYS,
        update_cols=["app_batch_id", "app_organization_id", "payload", "status"],
        target_pred=F.col("processed_ts").isNull(),
        null_keys=False,
    )


def purge_delivered(raw: DataFrame, keys: DataFrame) -> DataFrame:
    """The raw people that stay once the delivered batches are dropped."""
    return delete_matching(raw, keys, BATCH_KEYS)
