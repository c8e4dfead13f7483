"""Batch metrics in long form and the JSON payloads built from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namelens.plans.baseline import BATCH_KEYS

METRIC_KEYS = [
    "client_id",
    "batch_id",
    "model_version",
    "metric_name",
    "metric_type",
    "metric_label",
]


@dataclass(frozen=True)
class Metric:
    """One metric: its label (an expression) and amount (a column) in an aggregated cell."""

    name: str
    label: str
    amount: str
    label_sort: str | None = None
    average: bool = False
    matched: bool = True


# Names, labels and order are part of the delivered payload.
GENDER = Metric("Gender", "gender", "n", "VALUE")
CONFIDENCE = Metric("Confidence Level", "level", "n", "CONFIDENCE")
UNCOMMON = Metric("Uncommon Names", "'TOTAL_UNCOMMON_NAMES'", "rare")
MISSING = Metric("Missing First Name", "'MISSING_FIRST_NAME'", "missing", matched=False)
UNMATCHED = Metric("Unmatched Records", "'UNMATCHED'", "unmatched", matched=False)
MAX_PROBABILITY = Metric(
    "Average Max Probability", "'AVERAGE_MAX_PROBABILITY'", "max_micros", average=True
)
GAP = Metric("Average Probability Gap", "'AVERAGE_PROBABILITY_GAP'", "gap_micros", average=True)
CURRENT_METRICS = (GENDER, CONFIDENCE, UNCOMMON, MISSING, UNMATCHED, MAX_PROBABILITY, GAP)
OLDER_METRICS = (GENDER, CONFIDENCE, UNCOMMON, MISSING, MAX_PROBABILITY, GAP)


def _micros(probability: str) -> Column:
    """A six-decimal number as a whole number of millionths, for fast exact sums."""
    return (F.col(probability) * 1_000_000).cast("bigint")


def batch_metrics(baseline: DataFrame, model_version: str, matched_only: bool = True) -> DataFrame:
    """All metrics of all batches from one pass over the people.

    People are first added up per batch, match flag, gender and confidence; the
    metrics are then made from those few cells. ``matched_only=False`` gives the
    older set: no unmatched metric, and unmatched people count everywhere (with
    a null gender and confidence label).
    """
    metrics = CURRENT_METRICS if matched_only else OLDER_METRICS
    cells = baseline.groupBy(
        *BATCH_KEYS,
        F.coalesce("ssa_lookup_match_flag", F.lit(0)).alias("match"),
        F.col("ssa_reportable_gender").alias("gender"),
        F.col("ssa_confidence_level").alias("level"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("ssa_is_rare_name") == 1).alias("rare"),
        F.count_if(F.col("first_name_missing_flag") == 1).alias("missing"),
        F.count_if(F.coalesce("ssa_lookup_match_flag", F.lit(0)) == 0).alias("unmatched"),
        F.sum(_micros("ssa_max_probability")).alias("max_micros"),
        F.count("ssa_max_probability").alias("max_micros_n"),
        F.sum(_micros("ssa_probability_gap")).alias("gap_micros"),
        F.count("ssa_probability_gap").alias("gap_micros_n"),
        F.max("load_ts").alias("ts"),
    )
    entries = []
    for sort, m in enumerate(metrics, start=1):
        parts = F.struct(
            F.lit(m.name).alias("metric_name"),
            F.lit("AVERAGE" if m.average else "COUNT").alias("metric_type"),
            F.lit("PERCENT" if m.average else "INTEGER").alias("metric_display_type"),
            F.expr(m.label).cast("string").alias("metric_label"),
            F.lit(m.label_sort).cast("string").alias("metric_label_sort"),
            F.lit(sort).alias("metric_sort"),
            F.col(m.amount).alias("amount"),
            F.col(f"{m.amount}_n" if m.average else "n").alias("weight"),
        )
        wanted = (F.col("match") == 1) if matched_only and m.matched else F.lit(True)
        entries.append(F.when(wanted, parts))
    long = cells.select(
        *BATCH_KEYS, "ts", F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull()))
    )
    totals = long.groupBy(
        *BATCH_KEYS,
        "metric_name",
        "metric_type",
        "metric_display_type",
        "metric_label",
        "metric_label_sort",
        "metric_sort",
    ).agg(
        F.sum("amount").alias("amount"),
        F.sum("weight").alias("weight"),
        F.max("ts").alias("processed_ts"),
    )
    amount = F.col("amount").cast("decimal(20,0)")
    weight = F.nullif(F.col("weight"), F.lit(0)).cast("decimal(20,0)")
    mean = (F.round(amount / weight, 0).cast("decimal(20,0)") / 1_000_000).cast("decimal(32,6)")
    return totals.select(
        *BATCH_KEYS,
        F.lit(model_version).alias("model_version"),
        "metric_name",
        "metric_type",
        "metric_display_type",
        "metric_label",
        F.when(F.col("metric_type") == "AVERAGE", mean)
        .otherwise(amount.cast("decimal(32,6)"))
        .alias("metric_value"),
        "metric_label_sort",
        "metric_sort",
        "processed_ts",
    )


def plain_number(value: Column) -> Column:
    """A decimal without trailing zeros, as a JSON value."""
    return F.parse_json(value.cast("string"))


def _ordered(keys: list[Column], payload: Column) -> Column:
    """Payloads collected in key order. Null keys come last."""
    sort = []
    for i, k in enumerate(keys):
        sort += [k.isNull().alias(f"_n{i}"), k.alias(f"_k{i}")]
    rows = F.array_sort(F.collect_list(F.struct(*sort, payload.alias("_payload"))))
    return F.transform(rows, lambda r: r["_payload"])


def metric_blocks(summary: DataFrame) -> DataFrame:
    """The nested metrics of each batch and model version as one JSON text.

    A batch has a fixed number of metrics and labels, so its arrays stay small
    however many people it has. Object keys are in alphabetical order and null
    values are left out.
    """
    named = summary.groupBy(*BATCH_KEYS, "model_version", "metric_name").agg(
        F.any_value("metric_type").alias("metric_type"),
        F.any_value("metric_display_type").alias("metric_display_type"),
        F.any_value("metric_label_sort").alias("metric_label_sort"),
        F.any_value("metric_sort").alias("metric_sort"),
        _ordered(
            [F.col("metric_label")],
            F.to_json(
                F.struct(
                    F.col("metric_label").alias("label"),
                    plain_number(F.col("metric_value")).alias("value"),
                )
            ),
        ).alias("values"),
    )
    head = F.to_json(
        F.struct(
            "metric_display_type", "metric_label_sort", "metric_name", "metric_sort", "metric_type"
        )
    )
    # "metrics" sorts after all the other keys, so it is added at the end.
    block = F.concat(
        F.expr("substring(head, 1, length(head) - 1)"),
        F.lit(',"metrics":['),
        F.array_join("values", ","),
        F.lit("]}"),
    )
    blocks = named.withColumn("head", head).withColumn("block", block)
    body = blocks.groupBy(*BATCH_KEYS, "model_version").agg(
        _ordered([F.col("metric_sort"), F.col("metric_name")], F.col("block")).alias("blocks")
    )
    return body.select(
        *BATCH_KEYS,
        "model_version",
        F.concat(
            F.lit('{"analysis_type":"gender_metrics","metrics":['),
            F.array_join("blocks", ","),
            F.lit("]}"),
        ).alias("enrichment_metrics_payload"),
    )


def metrics_payload(summary: DataFrame, model_version: str) -> DataFrame:
    """The metrics text of one model version."""
    return metric_blocks(summary.where(F.col("model_version") == model_version))
