"""Joins of large, possibly skewed row sets with keyed tables of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namelens.operators.snapshot import measured_bytes, snapshot

BROADCAST_LIMIT_BYTES = 128 * 1024 * 1024
HOT_KEY_ROWS = 1_000_000
HOT_KEY_SALTS = 32


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def row_hash(df: DataFrame) -> Column:
    """A spread over rows that also parts exact copies read by different tasks."""
    return F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in df.columns])


def keyed_join(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    stored: bool = False,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    hot_key_rows: int = HOT_KEY_ROWS,
    salts: int = HOT_KEY_SALTS,
) -> DataFrame:
    """Join ``rows`` with a ``table`` that has few rows per key.

    ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``. The table is
    written once (unless ``stored``) and measured. Below ``broadcast_limit`` it
    is broadcast, so ``rows`` are not shuffled. Beyond it, both sides shuffle:
    keys with at least ``hot_key_rows`` rows are split over ``salts`` partitions
    and rows with a null key, which match nothing, are spread as well.
    """
    on = list(on)
    if how in ("left_semi", "left_anti"):
        table = table.select(*on).where(~any_null(on)).distinct()
    if not stored:
        table = snapshot(table, "join-side")
    if measured_bytes(table) <= broadcast_limit:
        return rows.join(F.broadcast(table), on, how)
    return salted_join(rows, table, on, how, hot_key_rows=hot_key_rows, salts=salts)


def salted_join(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str,
    *,
    hot_key_rows: int = HOT_KEY_ROWS,
    salts: int = HOT_KEY_SALTS,
) -> DataFrame:
    """Shuffle join in which no single task gets all rows of a hot key.

    At most ``count(rows) / hot_key_rows`` keys can be hot. They are counted
    with map-side partial sums, so the count itself is not skewed.
    """
    on = list(on)
    hot = snapshot(
        rows.where(~any_null(on))
        .groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") >= hot_key_rows)
        .select(*on, F.lit(True).alias("_hot")),
        "hot-keys",
    )
    spread = F.pmod(row_hash(rows), F.lit(salts)).cast("int")
    # No hint on the hot keys: Spark broadcasts the stored list by its file size.
    salted_rows = rows.withColumn("_spread", spread).join(hot, on, "left")
    salted_rows = salted_rows.withColumn(
        "_salt", F.when(any_null(on) | F.col("_hot"), F.col("_spread")).otherwise(F.lit(0))
    ).drop("_hot", "_spread")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    salted_table = (
        table.join(hot, on, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    )
    return salted_rows.join(salted_table, [*on, "_salt"], how).drop("_salt")
