"""Row numbers over an order, without sorting a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from namelens.operators.joins import row_hash
from namelens.operators.snapshot import snapshot


def ranked(
    df: DataFrame,
    order: Sequence[Column],
    by: Sequence[str] = (),
    name: str = "row_number",
    partitions: int | None = None,
) -> DataFrame:
    """Add 1, 2, 3, … in ``order`` within each ``by`` group.

    Rows are range partitioned on (group, order), so a group of any size is
    shared out over many tasks. Each range is numbered by itself and shifted by
    the rows of the same group in the ranges before it.
    """
    by = list(by)
    # The hash comes last: it lets even rows with equal keys go to different ranges.
    order = [*order, row_hash(df)]
    keys = [f"_o{i}" for i in range(len(order))]
    keyed = df.select("*", *[c.alias(k) for c, k in zip(order, keys)])
    # Without a fixed number, adaptive execution joins small neighbouring ranges.
    if partitions is None:
        keyed = keyed.repartitionByRange(*by, *keys)
    else:
        keyed = keyed.repartitionByRange(partitions, *by, *keys)
    ranged = snapshot(keyed.withColumn("_range", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("_range", *by).agg(F.count(F.lit(1)).alias("_rows"))
    # At most one row per group and range that holds it.
    before = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    before = before.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("_range").alias("_r"),
        *[F.col(b).alias(f"_b_{b}") for b in by],
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
    )
    same = F.col("_range") == F.col("_r")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"_b_{b}"))
    inside = Window.partitionBy("_range", *by).orderBy(*keys)
    return (
        ranged.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, same)
        .withColumn(name, (F.col("_inside") + F.col("_before")).cast("bigint"))
        .drop("_range", "_r", "_inside", "_before", *keys, *[f"_b_{b}" for b in by])
    )


def with_new_ids(df: DataFrame, order: Sequence[Column], start: int, name: str = "id") -> DataFrame:
    """Number new rows from ``start + 1``, in a stable order."""
    return ranked(df, order, name=name).withColumn(name, F.col(name) + F.lit(start))
