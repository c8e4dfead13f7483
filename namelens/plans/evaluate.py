"""How well the lookups agree with what voters state about themselves.

Voters are added up per name before the join, so a common name is one row there,
whatever its share of the roll. Lookups are made per name too: both sides are
already partitioned by name and the join needs no further shuffle.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namelens.functions import decile, share
from namelens.plans.lookups import REFERENCE_YEAR, AgeScheme, voter_counts


def _votes_for(label: str, counts: dict[str, Column]) -> Column:
    """The number of voters who state what the column ``label`` predicts."""
    cases = [F.when(F.col(label) == value, n) for value, n in counts.items()]
    return F.coalesce(*cases, F.lit(0))


def gender_accuracy(
    lookup: DataFrame, voters: DataFrame, by_bucket: bool = False, cleaned: bool = True
) -> DataFrame:
    """Hit rates of the predicted and the reportable gender per confidence level.

    ``cleaned=False`` takes the raw voter roll.
    """
    gender = F.col("gender")
    counts = voter_counts(
        voters, {"men": gender == "M", "women": gender == "F", "n": F.lit(True)}, cleaned
    )
    stated = {"M": F.col("men"), "F": F.col("women")}
    scored = lookup.select(
        "first_name",
        "confidence_level",
        "predicted_gender",
        "reportable_gender",
        decile("max_probability").alias("max_probability_bucket"),
    )
    groups = ["confidence_level"] + (["max_probability_bucket"] if by_bucket else [])
    totals = (
        counts.join(scored, "first_name")
        .groupBy(*groups)
        .agg(
            F.sum(_votes_for("predicted_gender", stated)).alias("predicted_hits"),
            F.sum(_votes_for("reportable_gender", stated)).alias("reported_hits"),
            F.sum("n").alias("record_count"),
        )
    )
    return totals.select(
        *groups,
        share(F.col("predicted_hits"), F.col("record_count")).alias("ssa_predicted_accuracy"),
        share(F.col("reported_hits"), F.col("record_count")).alias("ssa_reported_accuracy"),
        "record_count",
    ).orderBy(*groups)


def age_accuracy(
    lookup: DataFrame,
    voters: DataFrame,
    scheme: AgeScheme,
    reference_year: int = REFERENCE_YEAR,
    by_bucket: bool = False,
    cleaned: bool = True,
) -> DataFrame:
    """Hit rate of the predicted age bucket, per confidence level or probability decile.

    Per confidence level, voters with an unknown name form the group with a null
    level and count as wrong. Per decile they are left out. ``cleaned=False`` takes
    the raw voter roll.
    """
    tests = scheme.holds(F.lit(reference_year) - F.col("birth_year"))
    stated = {label: F.col(stem) for label, stem in zip(scheme.labels, scheme.stems)}
    counts = (
        voter_counts(voters, dict(zip(scheme.stems, tests)), cleaned)
        .withColumn("n", reduce(add, stated.values()))
        .where(F.col("n") > 0)
    )
    scored = lookup.select(
        "first_name",
        "confidence_level",
        "predicted_age_bucket",
        decile("max_probability").alias("prob_bucket"),
    )
    group = "prob_bucket" if by_bucket else "confidence_level"
    totals = (
        counts.join(scored, "first_name", "inner" if by_bucket else "left")
        .groupBy(group)
        .agg(
            F.sum("n").alias("total_records"),
            F.sum(_votes_for("predicted_age_bucket", stated)).alias("correct_records"),
        )
    )
    out = totals.select(
        group,
        "total_records",
        "correct_records",
        share(F.col("correct_records"), F.col("total_records")).alias("percent_accuracy"),
    )
    if by_bucket:
        return out.orderBy(F.desc(group))
    # The order in which the levels are reported.
    levels = F.array(*[F.lit(v) for v in ("HIGH", "MEDIUM", "LOW", "AMBIGUOUS")])
    place = F.nullif(F.array_position(levels, F.col(group)), F.lit(0))
    return out.orderBy(place.asc_nulls_last())


def prob_histogram(lookup: DataFrame) -> DataFrame:
    """Names per probability decile, highest first."""
    return (
        lookup.groupBy(decile("max_probability").alias("prob_bucket"))
        .agg(F.count(F.lit(1)).alias("records"))
        .orderBy(F.desc("prob_bucket"))
    )


def rarest_name_per_year(raw: DataFrame) -> DataFrame:
    """The least common name of each gender and year; the first by name on a tie.

    An unknown quantity is no small one: it counts only where a group has no other.
    The least quantity is a hashed minimum with partial results, so no task sorts
    its rows; only the rows that have it go on.
    """
    least = raw.groupBy(F.col("gender").alias("_g"), F.col("year").alias("_y")).agg(
        F.min("quantity").alias("_least")
    )
    same = (
        F.col("gender").eqNullSafe(F.col("_g"))
        & F.col("year").eqNullSafe(F.col("_y"))
        & F.col("quantity").eqNullSafe(F.col("_least"))
    )
    return (
        raw.join(least, same)
        .groupBy("gender", "year", "quantity")
        .agg(F.min("first_name").alias("first_name"))
        .select("first_name", "gender", "year", "quantity")
        .orderBy("year", "gender")
    )


def name_history(stage: DataFrame, name: str, gender: str | None = None) -> DataFrame:
    """The counts of one name over the years."""
    rows = stage.where(F.col("first_name").ilike(name))
    if gender is not None:
        rows = rows.where(F.col("gender") == gender)
    return rows.select("first_name", "gender", "year", "quantity").orderBy("year", "gender")


def name_search(lookup: DataFrame, pattern: str) -> DataFrame:
    """Lookup rows whose name fits a case-insensitive pattern."""
    return lookup.where(F.col("first_name").ilike(pattern))
