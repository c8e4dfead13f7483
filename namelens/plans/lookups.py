"""Reference data: cleaned name counts and voter rolls, and the lookups made from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namelens.functions import flag, normalize_gender, normalize_name, normalize_zip5, share

# The model's confidence limits, in falling order.
GENDER_THRESHOLDS = {"HIGH": "0.90", "MEDIUM": "0.75", "LOW": "0.60"}
AGE_4_THRESHOLDS = {"HIGH": "0.70", "MEDIUM": "0.55", "LOW": "0.40"}
AGE_7_THRESHOLDS = {"HIGH": "0.85", "MEDIUM": "0.70", "LOW": "0.60"}
REPORTABLE_FROM = "0.75"
RARE_BELOW = 100
MIN_AGE_TOTAL = 250
REFERENCE_YEAR = 2026


@dataclass(frozen=True)
class AgeScheme:
    """Age buckets, youngest first, as (from, to) with ``None`` for no upper end."""

    bounds: tuple[tuple[int, int | None], ...]
    thresholds: Mapping[str, str]

    @property
    def labels(self) -> list[str]:
        return [f"{lo}_PLUS" if hi is None else f"{lo}_{hi}" for lo, hi in self.bounds]

    @property
    def stems(self) -> list[str]:
        return [f"age_{label.lower()}" for label in self.labels]

    def holds(self, age: Column) -> list[Column]:
        """One test per bucket; ages below zero are in none."""
        return [age >= lo if hi is None else age.between(lo, hi) for lo, hi in self.bounds]

    def bucket(self, age: Column) -> Column:
        return F.coalesce(*[F.when(t, F.lit(n)) for t, n in zip(self.holds(age), self.labels)])


GENERIC_AGES = AgeScheme(((0, 24), (25, 44), (45, 64), (65, None)), AGE_4_THRESHOLDS)
SPECIFIC_AGES = AgeScheme(
    ((0, 17), (18, 24), (25, 34), (35, 44), (45, 54), (55, 64), (65, None)), AGE_7_THRESHOLDS
)


def confidence(probability: Column, thresholds: Mapping[str, str]) -> Column:
    """The first level whose limit is reached, else ``AMBIGUOUS``."""
    levels = [
        F.when(probability >= F.lit(Decimal(limit)), F.lit(level))
        for level, limit in thresholds.items()
    ]
    return F.coalesce(*levels, F.lit("AMBIGUOUS"))


def valid_name_counts(raw: DataFrame) -> DataFrame:
    """Name counts with a gender, a quantity and a year; names still as they came.

    The not-null test is on the raw name, so a name without letters stays; it is
    cleaned to a null name, which can never match a person.
    """
    return raw.select(
        "first_name",
        normalize_gender("gender").alias("gender"),
        F.col("quantity").cast("bigint").alias("quantity"),
        F.col("year").cast("int").alias("year"),
    ).where(
        F.col("first_name").isNotNull()
        & F.col("gender").isNotNull()
        & F.col("quantity").isNotNull()
        & F.col("year").isNotNull()
    )


def name_count_stage(raw: DataFrame) -> DataFrame:
    """Cleaned name counts."""
    return valid_name_counts(raw).withColumn("first_name", normalize_name("first_name"))


def _per_name(rows: DataFrame, sums: Mapping[str, Column], cleaned: bool) -> DataFrame:
    """Sums per clean name.

    Names that are not cleaned yet are added up by their raw spelling first, so
    that each spelling is cleaned once and not on every row.
    """
    totals = rows.groupBy("first_name").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    if cleaned:
        return totals
    return (
        totals.withColumn("first_name", normalize_name("first_name"))
        .groupBy("first_name")
        .agg(*[F.sum(n).alias(n) for n in sums])
    )


VOTER_STAGE_COLUMNS = {
    "state_voter_id": F.col,
    "name_suffix": F.col,
    "first_name": normalize_name,
    "middle_name": normalize_name,
    "last_name": normalize_name,
    "gender": normalize_gender,
    "birth_year": F.col,
    "registration_zip_code": normalize_zip5,
    "registration_state": F.col,
    "mailing_zip_code": normalize_zip5,
    "mailing_state": F.col,
    "loaded_ts": F.col,
}


def voter_stage(raw: DataFrame) -> DataFrame:
    """Cleaned voter roll: rows with a usable first name and a stated gender."""
    cleaned = raw.select(
        *[make(name).alias(name) for name, make in VOTER_STAGE_COLUMNS.items() if name in raw.columns]
    )
    return cleaned.where(F.col("first_name").isNotNull() & F.col("gender").isNotNull())


def voter_counts(
    voters: DataFrame, counts: Mapping[str, Column], cleaned: bool = True
) -> DataFrame:
    """Voters per name that satisfy each of the given tests.

    ``cleaned=False`` takes the raw roll and applies the rules of ``voter_stage``.
    """
    if not cleaned:
        voters = voters.withColumn("gender", normalize_gender("gender")).where(
            F.col("gender").isNotNull() & F.col("first_name").isNotNull()
        )
    ones = {name: F.when(test, 1).otherwise(0) for name, test in counts.items()}
    return _per_name(voters, ones, cleaned).where(F.col("first_name").isNotNull())


def score_gender(counts: DataFrame) -> DataFrame:
    """Probabilities, prediction and confidence from male and female totals per name."""
    total = F.col("male_qty") + F.col("female_qty")
    male, female = F.col("male_probability"), F.col("female_probability")
    best = F.col("max_probability")
    lead = F.when(male > female, "M").when(female > male, "F").otherwise("U")
    return (
        counts.select(
            "first_name",
            "male_qty",
            "female_qty",
            total.alias("total_qty"),
            share(F.col("male_qty"), total).alias("male_probability"),
            share(F.col("female_qty"), total).alias("female_probability"),
        )
        .withColumn("max_probability", F.greatest(male, female))
        .withColumn("probability_gap", F.abs(male - female).cast("decimal(10,6)"))
        .withColumn("predicted_gender", lead)
        .withColumn(
            "reportable_gender",
            F.when(best >= F.lit(Decimal(REPORTABLE_FROM)), F.col("predicted_gender")).otherwise("U"),
        )
        .withColumn("confidence_level", confidence(best, GENDER_THRESHOLDS))
        .withColumn("is_rare_name", flag(F.col("total_qty") < RARE_BELOW))
    )


def gender_lookup(stage: DataFrame, cleaned: bool = True) -> DataFrame:
    """Name to gender, from birth counts.

    ``cleaned=False`` takes ``valid_name_counts`` instead of the cleaned stage;
    the result is the same.
    """
    quantity, gender = F.col("quantity"), F.col("gender")
    sums = {
        "male_qty": F.when(gender == "M", quantity).otherwise(0),
        "female_qty": F.when(gender == "F", quantity).otherwise(0),
    }
    return score_gender(_per_name(stage, sums, cleaned))


def voter_gender_lookup(voters: DataFrame, cleaned: bool = True) -> DataFrame:
    """Name to gender, from the number of voters."""
    gender = F.col("gender")
    tests = {"male_qty": gender == "M", "female_qty": gender == "F"}
    return score_gender(voter_counts(voters, tests, cleaned))


def age_lookup(
    stage: DataFrame,
    scheme: AgeScheme,
    reference_year: int = REFERENCE_YEAR,
    min_total: int = MIN_AGE_TOTAL,
    rare_below: int = RARE_BELOW,
    cleaned: bool = True,
) -> DataFrame:
    """Name to age bucket; on equal counts the youngest bucket wins.

    ``cleaned`` as in ``gender_lookup``.
    """
    age = F.lit(reference_year) - F.col("year")
    sums = {
        f"{stem}_qty": F.when(test, F.col("quantity")).otherwise(0)
        for test, stem in zip(scheme.holds(age), scheme.stems)
    }
    known = stage.where(
        F.col("first_name").isNotNull() & F.col("year").isNotNull() & F.col("quantity").isNotNull()
    )
    counts = _per_name(known, sums, cleaned).where(F.col("first_name").isNotNull())
    quantities: Sequence[Column] = [F.col(f"{stem}_qty") for stem in scheme.stems]
    total, best = F.col("total_qty"), F.col("max_probability")
    largest = F.greatest(*quantities)
    return (
        counts.select(
            "first_name",
            F.lit(reference_year).alias("reference_year"),
            *quantities,
            sum(quantities[1:], quantities[0]).alias("total_qty"),
        )
        .select(
            "*",
            *[share(q, total).alias(f"{s}_probability") for q, s in zip(quantities, scheme.stems)],
            share(largest, total).alias("max_probability"),
            F.coalesce(
                *[F.when(q == largest, F.lit(n)) for q, n in zip(quantities, scheme.labels)]
            ).alias("predicted_age_bucket"),
        )
        .withColumn(
            "confidence_level",
            F.when(total < min_total, "AMBIGUOUS").otherwise(confidence(best, scheme.thresholds)),
        )
        .withColumn("is_rare_name", flag(total < rare_below))
    )
