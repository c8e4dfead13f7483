"""Client people: cleaning, the lookup joins and the views over their results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namelens.functions import flag, normalize_name, normalize_zip5, share
from namelens.operators import keyed_join

BATCH_KEYS = ["client_id", "batch_id"]
RECORD_KEYS = ["client_id", "batch_id", "record_id"]


def person_clean(raw: DataFrame) -> DataFrame:
    """Raw fields kept, cleaned fields, flags and lengths beside them."""
    return raw.select(
        *RECORD_KEYS,
        F.col("first_name").alias("first_name_raw"),
        F.col("last_name").alias("last_name_raw"),
        F.col("zip").alias("zip_raw"),
        normalize_name("first_name").alias("first_name_clean"),
        normalize_name("last_name").alias("last_name_clean"),
        normalize_zip5("zip").alias("zip5"),
        "load_ts",
    ).select(
        *RECORD_KEYS,
        "first_name_raw",
        "last_name_raw",
        "zip_raw",
        "first_name_clean",
        "last_name_clean",
        "zip5",
        flag(F.col("first_name_clean").isNull()).alias("first_name_missing_flag"),
        flag(F.col("last_name_clean").isNull()).alias("last_name_missing_flag"),
        flag(F.col("zip5").isNull()).alias("zip_unusable_flag"),
        F.length("first_name_clean").alias("first_name_length"),
        F.length("last_name_clean").alias("last_name_length"),
        "load_ts",
    )


PERSON_COLUMNS = [
    *RECORD_KEYS,
    "first_name_raw",
    "last_name_raw",
    "zip_raw",
    "first_name_clean",
    "last_name_clean",
    "zip5",
    "first_name_missing_flag",
    "zip_unusable_flag",
    "first_name_length",
    "load_ts",
]

# Lookup column -> baseline column, in output order.
GENDER_COLUMNS = {
    "male_qty": "ssa_male_qty",
    "female_qty": "ssa_female_qty",
    "total_qty": "ssa_total_qty",
    "male_probability": "ssa_male_probability",
    "female_probability": "ssa_female_probability",
    "max_probability": "ssa_max_probability",
    "probability_gap": "ssa_probability_gap",
    "predicted_gender": "ssa_predicted_gender",
    "confidence_level": "ssa_confidence_level",
    "is_rare_name": "ssa_is_rare_name",
    "reportable_gender": "ssa_reportable_gender",
}
AGE_COLUMNS = {
    "total_qty": "ssa_age_total_qty",
    "max_probability": "ssa_age_max_probability",
    "predicted_age_bucket": "ssa_predicted_age_bucket",
    "confidence_level": "ssa_age_confidence_level",
    "is_rare_name": "ssa_age_is_rare_name",
}


def _with_lookup(
    clean: DataFrame, lookup: DataFrame, columns: dict[str, str], match_flag: str, **join: object
) -> DataFrame:
    side = lookup.where(F.col("first_name").isNotNull()).select(
        F.col("first_name").alias("first_name_clean"),
        F.lit(1).alias("_match"),
        *[F.col(have).alias(want) for have, want in columns.items()],
    )
    joined = keyed_join(clean.select(*PERSON_COLUMNS), side, ["first_name_clean"], "left", **join)
    return joined.select(
        *PERSON_COLUMNS,
        F.coalesce("_match", F.lit(0)).alias(match_flag),
        *columns.values(),
    )


def gender_baseline(clean: DataFrame, lookup: DataFrame, **join: object) -> DataFrame:
    """Every clean person with the gender scores of the first name, if known."""
    return _with_lookup(clean, lookup, GENDER_COLUMNS, "ssa_lookup_match_flag", **join)


def age_baseline(clean: DataFrame, lookup: DataFrame, **join: object) -> DataFrame:
    """Every clean person with the age scores of the first name, if known."""
    return _with_lookup(clean, lookup, AGE_COLUMNS, "ssa_age_lookup_match_flag", **join)


def low_confidence(store: DataFrame) -> DataFrame:
    """Stored model results with LOW or AMBIGUOUS confidence."""
    return store.where(F.col("ssa_confidence_level").isin("LOW", "AMBIGUOUS")).select(
        *RECORD_KEYS,
        "first_name_raw",
        "first_name_clean",
        "zip_raw",
        "zip5",
        "ssa_predicted_gender",
        "ssa_reportable_gender",
        "ssa_male_probability",
        # Fixed value: consumers know this column under its misspelt name.
        F.col("ssa_female_probability").alias("ssa_female_probablity"),
        "ssa_confidence_level",
        "model_version",
    )


def _count(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def unmatched_report(store: DataFrame) -> DataFrame:
    """Unmatched and weak results per batch, as counts and shares."""
    level = F.col("ssa_confidence_level")
    total = F.col("total_records")
    counts = store.groupBy(*BATCH_KEYS).agg(
        F.count(F.lit(1)).alias("total_records"),
        _count(F.col("ssa_lookup_match_flag") == 0, "unmatched_records"),
        _count(level == "LOW", "matched_low_records"),
        _count(level == "AMBIGUOUS", "matched_ambiguous_records"),
    )
    weak = F.col("matched_low_records") + F.col("matched_ambiguous_records")
    # Three of the share columns are known under misspelt names.
    return counts.select(
        *BATCH_KEYS,
        "total_records",
        "unmatched_records",
        share(F.col("unmatched_records"), total).alias("percent_unmatched"),
        "matched_low_records",
        share(F.col("matched_low_records"), total).alias("percent_low"),
        "matched_ambiguous_records",
        share(F.col("matched_ambiguous_records"), total).alias("percent_amgiguous"),
        weak.alias("match_low_ambiguous_records"),
        share(weak, total).alias("percent_low_amgiguous"),
    ).orderBy(*BATCH_KEYS, F.desc("percent_unmatched"))


def batch_gender_summary(baseline: DataFrame, model_version: str) -> DataFrame:
    """One wide row of counts per batch."""
    level, gender = F.col("ssa_confidence_level"), F.col("ssa_reportable_gender")
    counts = baseline.groupBy(*BATCH_KEYS).agg(
        F.count(F.lit(1)).alias("total_records"),
        _count(F.col("first_name_missing_flag") == 0, "usable_first_name_records"),
        _count(F.col("ssa_lookup_match_flag") == 1, "ssa_lookup_match_records"),
        _count(level == "HIGH", "high_confidence_records"),
        _count(level == "MEDIUM", "medium_confidence_records"),
        _count(level == "LOW", "low_confidence_records"),
        _count(level == "AMBIGUOUS", "ambiguous_records"),
        _count(gender == "M", "reportable_m_records"),
        _count(gender == "F", "reportable_f_records"),
        _count(gender == "U", "reportable_u_records"),
        F.max("load_ts").alias("processed_ts"),
    )
    return counts.select(
        F.col("client_id").cast("string").alias("client_id"),
        F.col("batch_id").cast("string").alias("batch_id"),
        F.lit(model_version).alias("model_version"),
        "total_records",
        "usable_first_name_records",
        "ssa_lookup_match_records",
        share(F.col("ssa_lookup_match_records"), F.col("total_records")).alias(
            "ssa_lookup_match_rate"
        ),
        "high_confidence_records",
        "medium_confidence_records",
        "low_confidence_records",
        "ambiguous_records",
        "reportable_m_records",
        "reportable_f_records",
        "reportable_u_records",
        "processed_ts",
    )


def batch_record_counts(raw: DataFrame) -> DataFrame:
    """Records per batch."""
    return raw.groupBy(*BATCH_KEYS).agg(F.count(F.lit(1)).alias("record_count"))


def confidence_distribution(baseline: DataFrame) -> DataFrame:
    return baseline.groupBy("ssa_confidence_level").agg(F.count(F.lit(1)).alias("record_count"))


def non_high_records(baseline: DataFrame) -> DataFrame:
    """Matched people whose confidence is not HIGH; unmatched people are left out."""
    return baseline.where(F.col("ssa_confidence_level") != "HIGH").select(
        "first_name_raw",
        "first_name_clean",
        "ssa_is_rare_name",
        "ssa_confidence_level",
        "ssa_female_probability",
        "ssa_male_probability",
        "ssa_predicted_gender",
        "ssa_reportable_gender",
    )
