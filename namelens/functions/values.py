"""Safe casts, exact shares and the numeric-first record order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

PROBABILITY_TYPE = "decimal(10,6)"

# The date spellings accepted on load.
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "dd-MMM-yyyy")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def try_number(value: Column | str, to: str = "decimal(38,0)") -> Column:
    """The number in a text, rounded to the target type; null when it is not a number."""
    return F.trim(_col(value)).try_cast("decimal(38,0)").try_cast(to)


def try_date(value: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The date in a text under the first format that fits, else null."""
    text = F.trim(_col(value))
    return F.coalesce(*[F.try_to_date(text, fmt) for fmt in formats])


def share(part: Column, total: Column) -> Column:
    """``part / total`` as an exact six-decimal number; null for a zero total."""
    part = part.cast("decimal(32,0)")
    total = total.cast("decimal(32,0)")
    return (part / F.nullif(total, F.lit(0).cast("decimal(32,0)"))).cast(PROBABILITY_TYPE)


def decile(probability: Column | str) -> Column:
    """A probability cut down to one decimal place."""
    return (F.floor(_col(probability) * 10) / 10).cast("decimal(2,1)")


def record_order(record_id: Column | str) -> list[Column]:
    """Sort keys: numeric ids first and by value, then the other ids as text."""
    record_id = _col(record_id)
    number = try_number(record_id)
    return [number.isNull(), number, record_id]
