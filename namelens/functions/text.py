"""Cleaning of names, ZIP codes and gender codes, as plain Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the cleaning rests on; the SQL functions are made from the same values.
NO_ASCII_LETTERS = "[^a-z]+"
NO_LETTERS = r"\P{L}+"
NO_DIGITS = "[^0-9]+"
ZIP_DIGITS = 5
GENDER_SPELLINGS = {"M": ("M", "MALE"), "F": ("F", "FEMALE")}


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def normalize_name(value: Column | str, unicode: bool = False) -> Column:
    """Lower-case letters only; nothing left over means null.

    ``unicode=True`` keeps letters outside a-z (``é``) instead of dropping them.
    """
    others = NO_LETTERS if unicode else NO_ASCII_LETTERS
    letters = F.regexp_replace(F.lower(F.trim(_col(value))), others, "")
    return F.nullif(letters, F.lit(""))


def normalize_zip5(value: Column | str) -> Column:
    """First five digits, or null when there are fewer than five."""
    digits = F.regexp_replace(_col(value), NO_DIGITS, "")
    return F.when(F.length(digits) >= ZIP_DIGITS, F.substring(digits, 1, ZIP_DIGITS))


def normalize_gender(value: Column | str) -> Column:
    """``M`` or ``F`` for the accepted spellings, null for anything else."""
    code = F.upper(F.trim(_col(value)))
    found = F.lit(None).cast("string")
    for gender, spellings in GENDER_SPELLINGS.items():
        found = F.when(code.isin(*spellings), gender).otherwise(found)
    return found


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.when(condition, 1).otherwise(0)
