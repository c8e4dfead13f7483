"""Result files: which columns, which rows, and the queue that announces them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namelens.operators import keyed_join, upsert
from namelens.plans.approval import parsed_config
from namelens.plans.baseline import RECORD_KEYS
from namelens.plans.enrichment import pending
from namelens.plans.ingest import APPROVAL_KEYS, batch_keys

# The columns a client can order, under their file names.
EXPORT_COLUMNS = (
    "RECORD_ID",
    "FIRST_NAME",
    "LAST_NAME",
    "ZIP",
    "MALE_PROBABILITY",
    "FEMALE_PROBABILITY",
    "GENDER_CONFIDENCE_LEVEL",
    "PREDICTED_GENDER",
)


def config_fields(configs: DataFrame) -> DataFrame:
    """The ordered export columns of each batch as an array.

    Fields without a sort order come first, then by sort order, then by name.
    Arrays are sorted in place, without exploding and grouping them.
    """
    named = F.filter("config.output_fields", lambda f: f["field_name"].isNotNull())
    keyed = F.transform(
        named,
        lambda f: F.struct(
            F.when(f["sort_order"].isNull(), 0).otherwise(1).alias("placed"),
            f["sort_order"].alias("sort_order"),
            f["field_name"].alias("field_name"),
        ),
    )
    return parsed_config(configs).select(
        *APPROVAL_KEYS,
        F.transform(F.array_sort(keyed), lambda f: f["field_name"]).alias("fields"),
    )


def config_select_list(configs: DataFrame, alias: str = "SRC") -> DataFrame:
    """The ordered export columns of each batch as a select list."""
    qualified = F.transform("fields", lambda f: F.concat(F.lit(f"{alias}."), f))
    listed = config_fields(configs).select(
        *APPROVAL_KEYS, F.nullif(F.array_join(qualified, ", "), F.lit("")).alias("select_list")
    )
    return listed.where(F.col("select_list").isNotNull())


def export_lists(keys: DataFrame, configs: DataFrame) -> DataFrame:
    """The batches in ``keys`` with their export columns; all columns when none are configured."""
    every = F.array(*[F.lit(c) for c in EXPORT_COLUMNS])
    known = F.filter("fields", lambda c: F.array_contains(every, c))
    wanted = F.when(F.size(known) > 0, known)
    fields = config_fields(configs).select(*APPROVAL_KEYS, wanted.alias("columns"))
    return keys.join(fields, APPROVAL_KEYS, "left").withColumn(
        "columns", F.coalesce("columns", every)
    )


def ordered_columns(configs: DataFrame, organization: str, batch: str) -> list[str]:
    """The export columns of one batch; all of them when nothing is configured.

    Only known column names pass.
    """
    key = configs.sparkSession.createDataFrame(
        [(organization, batch)], "app_organization_id string, app_batch_id string"
    )
    return export_lists(key, configs).first()["columns"]


def download_rows(raw: DataFrame, results: DataFrame) -> DataFrame:
    """Every raw person with the exported result fields, if enriched; app-side keys and column lists are kept."""
    scored = results.select(
        *RECORD_KEYS,
        "male_probability",
        "female_probability",
        F.col("confidence_level").alias("gender_confidence_level"),
        F.col("reportable_gender").alias("predicted_gender"),
    )
    kept = [c for c in [*APPROVAL_KEYS, "columns"] if c in raw.columns]
    return raw.join(scored, RECORD_KEYS, "left").select(
        *kept,
        *RECORD_KEYS,
        "first_name",
        "last_name",
        "zip",
        "male_probability",
        "female_probability",
        "gender_confidence_level",
        "predicted_gender",
    )


def export_projection(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The ordered columns under their file names."""
    unknown = [c for c in columns if c not in EXPORT_COLUMNS]
    if unknown:
        raise ValueError(f"not exportable: {unknown}")
    return rows.select(*[F.col(c.lower()).alias(c) for c in columns])


def object_key(organization: Column, batch: Column) -> Column:
    """Where the result file of a batch lies."""
    return F.concat(
        F.lit("downloads/"),
        organization,
        F.lit("/"),
        batch,
        F.lit("/results_"),
        batch,
        F.lit(".csv.gz"),
    )


def resolve_batch(clients: DataFrame, batches: DataFrame, organization: str, batch: str):
    """(client id, batch id) of an app-side batch, or None."""
    mine = (F.col("app_organization_id") == organization) & (F.col("app_batch_id") == batch)
    row = batch_keys(clients, batches).where(mine).first()
    return (row["client_id"], row["batch_id"]) if row else None


def pending_keys(queue: DataFrame, clients: DataFrame, batches: DataFrame) -> DataFrame:
    """The batches with a pending download, under both their keys."""
    wanted = pending(queue).select(*APPROVAL_KEYS).distinct()
    return wanted.join(batch_keys(clients, batches), APPROVAL_KEYS)


def pending_downloads(
    queue: DataFrame, clients: DataFrame, batches: DataFrame, raw: DataFrame, results: DataFrame
) -> DataFrame:
    """The export rows of all batches with a pending download, in one job."""
    keys = pending_keys(queue, clients, batches)
    people = keyed_join(raw, keys, ["client_id", "batch_id"], "inner")
    return download_rows(people, results)


def folder_key(folder: str, organization: Column, batch: Column) -> Column:
    """Where the result folder of a batch lies that was exported together with others."""
    return F.concat(
        F.lit(f"{folder}/app_organization_id="), organization, F.lit("/app_batch_id="), batch
    )


def set_object_keys(batches: DataFrame, clients: DataFrame, ready: DataFrame) -> DataFrame:
    """Batches with the place of their result file."""
    done = ready.join(batch_keys(clients, batches), APPROVAL_KEYS).select(
        "client_id", F.col("batch_id").alias("id"), "download_object_key"
    )
    return upsert(batches, done, ["client_id", "id"], insert=False, null_keys=False)


def ready_entries(keys: DataFrame, place: Column | None = None) -> DataFrame:
    """Ready-queue rows for prepared batches, by default at their own object key."""
    if place is None:
        place = object_key(F.col("app_organization_id"), F.col("app_batch_id"))
    return keys.select(
        *APPROVAL_KEYS,
        place.alias("download_object_key"),
        F.lit("READY").alias("download_status"),
    )


def download_ready_upsert(queue: DataFrame, entries: DataFrame, run_ts: Column) -> DataFrame:
    """The ready queue after a preparation: prepared batches wait again, from the start."""
    return upsert(
        queue,
        entries,
        APPROVAL_KEYS,
        set_literals={
            "processing_status": F.lit("PENDING"),
            "processing_started_ts": F.lit(None),
            "processed_ts": F.lit(None),
            "error_message": F.lit(None),
            "updated_ts": run_ts,
        },
        insert_literals={
            "queued_ts": run_ts,
            "processing_status": F.lit("PENDING"),
            "created_ts": run_ts,
            "updated_ts": run_ts,
        },
        null_keys=False,
    )
