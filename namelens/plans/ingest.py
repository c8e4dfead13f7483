"""From landed file rows to registered batches, raw people and approval requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namelens.functions import parse_upload_path
from namelens.operators import insert_absent, keyed_join
from namelens.operators.upsert import add_absent

APPROVAL_KEYS = ["app_organization_id", "app_batch_id"]


def parse_landing(landing: DataFrame) -> DataFrame:
    """Landed rows with the tenant, batch and file name their path states."""
    return landing.select(
        "*", *[c.alias(name) for name, c in parse_upload_path("storage_file_name").items()]
    )


def landed_files(landing: DataFrame) -> DataFrame:
    """One row per landed file: its number of records and what its path states.

    Paths are taken apart once per file instead of once per record.
    """
    files = landing.groupBy("storage_file_name").agg(F.count(F.lit(1)).alias("record_count"))
    return parse_landing(files)


def register_batches(files: DataFrame, clients: DataFrame, batches: DataFrame) -> DataFrame:
    """New batch rows, without an id yet: one per unknown batch of a known client.

    A batch that came in several files is one batch, named by the first of them.
    """
    owners = clients.select("app_organization_id", F.col("id").alias("client_id"))
    known = batches.select("client_id", "app_batch_id")
    return (
        files.join(owners, "app_organization_id")
        .join(known, ["client_id", "app_batch_id"], "left_anti")
        .groupBy("client_id", "app_batch_id")
        .agg(
            F.min_by("original_source_file_name", "storage_file_name").alias("file_name"),
            F.sum("record_count").alias("record_count"),
            F.min("storage_file_name").alias("storage_file_name"),
        )
        .select("client_id", "file_name", "record_count", "app_batch_id", "storage_file_name")
    )


def batch_keys(clients: DataFrame, batches: DataFrame) -> DataFrame:
    """The batches with both their own and their app-side keys: one row per app-side batch.

    Should a table have several ids for one, the lowest counts, so people are not multiplied.
    """
    owners = clients.select("app_organization_id", F.col("id").alias("client_id"))
    return (
        batches.join(owners, "client_id")
        .groupBy("app_organization_id", "app_batch_id", "client_id")
        .agg(F.min("id").alias("batch_id"))
    )


def raw_rows(
    landing: DataFrame, files: DataFrame, clients: DataFrame, batches: DataFrame, raw: DataFrame
) -> DataFrame:
    """The landed people that are not in ``raw`` yet, with client and batch id.

    A batch belongs to a client, so files find it under both app-side keys.
    """
    owned = files.join(batch_keys(clients, batches), APPROVAL_KEYS).select(
        "storage_file_name", "client_id", "batch_id"
    )
    found = keyed_join(landing, owned, ["storage_file_name"], "inner").select(
        "client_id", "batch_id", "record_id", "first_name", "last_name", "zip", "load_ts"
    )
    return insert_absent(raw, found, ["client_id", "batch_id", "record_id"])


def approval_entries(files: DataFrame, clients: DataFrame, batches: DataFrame) -> DataFrame:
    """One pending approval per landed batch."""
    landed = files.select(*APPROVAL_KEYS).distinct()
    return landed.join(batch_keys(clients, batches), APPROVAL_KEYS).select(
        *APPROVAL_KEYS, "batch_id", F.lit("PENDING").alias("status")
    )


def enqueue_approval(queue: DataFrame, entries: DataFrame, run_ts: Column) -> DataFrame:
    """The approval queue plus the entries it lacks; queued ones stay as they are.

    A batch that came in several files is one request, under its lowest id.
    """
    entries = entries.groupBy(*APPROVAL_KEYS).agg(
        F.min("batch_id").alias("batch_id"), F.any_value("status").alias("status")
    )
    return add_absent(
        queue,
        entries,
        APPROVAL_KEYS,
        insert_literals={"created_ts": run_ts, "updated_ts": run_ts},
        null_keys=False,
    )


def file_membership(files: DataFrame) -> DataFrame:
    """Which batch each landed file is of; a file outside any batch is of none."""
    named = F.col("app_organization_id").isNotNull() & F.col("app_batch_id").isNotNull()
    return files.where(named).select(*APPROVAL_KEYS, "storage_file_name").distinct()
