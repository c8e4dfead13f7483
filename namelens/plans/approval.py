"""Credit approval: requests out, decisions in, enrichment requests from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namelens.operators import delete_matching, upsert
from namelens.plans.ingest import APPROVAL_KEYS, batch_keys
from namelens.schemas import CONFIG_JSON

DECISION_COLUMNS = [
    "status",
    "requested_credits",
    "approved_credits",
    "denial_reason",
    "decision_ts",
]
STATUS_KEYS = ["client_id", "batch_id", "app_batch_id", "enrichment_type_code"]


def approval_requests(queue: DataFrame, batches: DataFrame) -> DataFrame:
    """What to ask the credit service: pending batches with their record counts."""
    counts = batches.groupBy("app_batch_id").agg(F.max("record_count").alias("record_count"))
    pending = (
        queue.where(F.col("status") == "PENDING").select(*APPROVAL_KEYS, "created_ts").distinct()
    )
    return pending.join(counts, "app_batch_id").select(
        F.col("app_organization_id").alias("organization_id"),
        F.col("app_batch_id").alias("batch_id"),
        F.col("created_ts").alias("created_at"),
        F.coalesce("record_count", F.lit(0)).alias("record_count"),
    )


def approval_message(requests: DataFrame) -> DataFrame:
    """Each request as the JSON object that the credit service takes."""
    return requests.select(
        F.to_json(
            F.struct(
                "record_count",
                "organization_id",
                "batch_id",
                F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
            ),
            {"ignoreNullFields": "false"},
        ).alias("request")
    )


def latest_approval(results: DataFrame, tie_break: str | None = None) -> DataFrame:
    """The last decision per batch.

    A maximum over (time, tie break, row) instead of a sorted window, so a batch
    with very many decisions is reduced before the shuffle.
    """
    decided = F.coalesce(
        *[F.col(c) for c in ("decision_ts", "updated_ts", "created_ts") if c in results.columns]
    )
    rest = [c for c in results.columns if c not in APPROVAL_KEYS]
    ties = [F.col(tie_break)] if tie_break else []
    rank = F.struct(decided.alias("_at"), *[t.alias("_tie") for t in ties], F.struct(*rest).alias("row"))
    return (
        results.groupBy(*APPROVAL_KEYS)
        .agg(F.max(rank).alias("last"))
        .select(*APPROVAL_KEYS, "last.row.*")
    )


def apply_decisions(queue: DataFrame, decisions: DataFrame, run_ts: Column) -> DataFrame:
    """The approval queue with the decisions written onto the rows they are about."""
    return upsert(
        queue,
        decisions.select(*APPROVAL_KEYS, *DECISION_COLUMNS),
        APPROVAL_KEYS,
        update_cols=DECISION_COLUMNS,
        set_literals={"updated_ts": run_ts},
        insert=False,
        null_keys=False,
    )


def approved(decisions: DataFrame) -> DataFrame:
    return decisions.where(F.col("status") == "APPROVED").select(*APPROVAL_KEYS).distinct()


def parsed_config(configs: DataFrame) -> DataFrame:
    """Configurations with their JSON read into typed columns; bad JSON gives nulls."""
    return configs.select(*APPROVAL_KEYS, F.from_json("config_json", CONFIG_JSON).alias("config"))


def variant_config(configs: DataFrame) -> DataFrame:
    """Configurations as variants: any fields are kept, bad JSON is null."""
    return configs.select(*APPROVAL_KEYS, F.try_parse_json("config_json").alias("config"))


def config_parts(configs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ordered enrichments (code, label) and export fields (field_name, sort_order) of variants.

    An explicit JSON null counts as absent: a code or field name that is null
    orders nothing, a null sort order places a field first. What is not an array,
    or not of the right type, is left out.
    """

    def each(path: str) -> DataFrame:
        items = F.try_variant_get("config", path, "array<variant>")
        return configs.select(*APPROVAL_KEYS, F.explode(items).alias("item"))

    def field(name: str, kind: str) -> Column:
        return F.try_variant_get("item", f"$.{name}", kind).alias(name)

    attributes = each("$.attributes").select(*APPROVAL_KEYS, field("code", "string"), field("label", "string"))
    fields = each("$.output_fields").select(*APPROVAL_KEYS, field("field_name", "string"), field("sort_order", "int"))
    return attributes.where(F.col("code").isNotNull()), fields.where(F.col("field_name").isNotNull())


def enrichment_requests(
    decisions: DataFrame,
    clients: DataFrame,
    batches: DataFrame,
    configs: DataFrame,
    statuses: DataFrame,
) -> DataFrame:
    """A pending status row per approved batch and configured enrichment, if not there yet."""
    attributes = (
        parsed_config(configs)
        .select(*APPROVAL_KEYS, F.inline("config.attributes"))
        .where(F.col("code").isNotNull())
    )
    wanted = (
        approved(decisions)
        .join(batch_keys(clients, batches), APPROVAL_KEYS)
        .join(attributes, APPROVAL_KEYS)
        .select(
            "client_id",
            "batch_id",
            "app_batch_id",
            F.col("label").alias("enrichment_type"),
            F.col("code").alias("enrichment_type_code"),
            F.lit("PENDING").alias("enrichment_status"),
        )
        .distinct()
    )
    return wanted.join(statuses.select(*STATUS_KEYS), STATUS_KEYS, "left_anti").select(
        "client_id",
        "batch_id",
        "app_batch_id",
        "enrichment_type",
        "enrichment_type_code",
        "enrichment_status",
    )


def approved_files(decisions: DataFrame, landed: DataFrame) -> DataFrame:
    """All files that approved batches were landed in; a batch may have several."""
    keys = approved(decisions)
    return landed.join(keys, APPROVAL_KEYS, "left_semi").select("storage_file_name").distinct()


def purge_approved_landing(
    landing: DataFrame, decisions: DataFrame, clients: DataFrame, batches: DataFrame
) -> DataFrame:
    """The landing rows that stay once the files of approved batches are dropped."""
    owners = clients.select("app_organization_id", F.col("id").alias("client_id"))
    files = (
        approved(decisions)
        .join(owners, "app_organization_id")
        .join(
            batches.select("client_id", "app_batch_id", "storage_file_name"),
            ["client_id", "app_batch_id"],
        )
        .select("storage_file_name")
    )
    return delete_matching(landing, files, ["storage_file_name"])
