from __future__ import annotations

from decimal import Decimal

import pytest

from namelens.plans import lookups
from namelens.plans.lookups import GENERIC_AGES, SPECIFIC_AGES

RAW = "first_name string, gender string, quantity bigint, year int"


def test_stage_keeps_a_name_without_letters_as_null(rows):
    raw = rows(
        [("Ann", "f", 5, 2000), ("123", "M", 5, 2000), (None, "M", 5, 2000), ("Al", "x", 5, 2000),
         ("Al", "M", None, 2000), ("Al", "M", 5, None)],
        RAW,
    )
    out = lookups.name_count_stage(raw).collect()
    assert [(r.first_name, r.gender, r.quantity, r.year) for r in out] == [
        ("ann", "F", 5, 2000), (None, "M", 5, 2000),
    ]


@pytest.mark.parametrize(
    "male, female, expected",
    [
        (60, 40, ("M", "U", "LOW", 0)),
        (75, 25, ("M", "M", "MEDIUM", 0)),
        (10, 90, ("F", "F", "HIGH", 0)),
        (50, 50, ("U", "U", "AMBIGUOUS", 0)),
        (59, 41, ("M", "U", "AMBIGUOUS", 0)),
        (8999996, 1000004, ("M", "M", "HIGH", 0)),
        (99, 0, ("M", "M", "HIGH", 1)),
        (0, 100, ("F", "F", "HIGH", 0)),
        (0, 0, ("U", "U", "AMBIGUOUS", 1)),
    ],
)
def test_gender_scores(rows, male, female, expected):
    stage = rows([("ann", "M", male, 2000), ("ann", "F", female, 2000)],
                 "first_name string, gender string, quantity bigint, year int")
    r = lookups.gender_lookup(stage).first()
    assert (r.predicted_gender, r.reportable_gender, r.confidence_level, r.is_rare_name) == expected
    assert r.total_qty == male + female
    if male + female:
        assert abs(r.male_probability + r.female_probability - 1) <= Decimal("0.000001")
        assert r.max_probability == max(r.male_probability, r.female_probability)
    else:
        assert r.max_probability is None and r.probability_gap is None


def ages(rows, scheme, counts):
    """Counts by age, in the reference year 2026."""
    stage = rows([("ann", "F", n, 2026 - age) for age, n in counts.items()],
                 "first_name string, gender string, quantity bigint, year int")
    return lookups.age_lookup(stage, scheme).first()


def test_age_edges(rows):
    r = ages(rows, SPECIFIC_AGES, {-1: 1000, 0: 1, 17: 2, 18: 4, 24: 8, 25: 16, 44: 32, 45: 64, 64: 128, 65: 256})
    assert [r[f"{s}_qty"] for s in SPECIFIC_AGES.stems] == [3, 12, 16, 32, 64, 128, 256]
    assert r.total_qty == 511 and r.predicted_age_bucket == "65_PLUS"
    r = ages(rows, GENERIC_AGES, {0: 1, 24: 2, 25: 4, 44: 8, 45: 16, 64: 32, 65: 64})
    assert [r[f"{s}_qty"] for s in GENERIC_AGES.stems] == [3, 12, 48, 64]


@pytest.mark.parametrize(
    "counts, bucket, level, rare",
    [
        ({10: 249}, "0_24", "AMBIGUOUS", 0),
        ({10: 250}, "0_24", "HIGH", 0),
        ({10: 125, 30: 125}, "0_24", "LOW", 0),
        ({30: 100, 70: 100, 50: 100}, "25_44", "AMBIGUOUS", 0),
        ({30: 99}, "25_44", "AMBIGUOUS", 1),
        ({-5: 400}, "0_24", "AMBIGUOUS", 1),
        ({30: 140, 50: 110}, "25_44", "MEDIUM", 0),
    ],
)
def test_age_scores(rows, counts, bucket, level, rare):
    r = ages(rows, GENERIC_AGES, counts)
    assert (r.predicted_age_bucket, r.confidence_level, r.is_rare_name) == (bucket, level, rare)
