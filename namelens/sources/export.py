"""Writing result files for clients."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namelens.operators import measured_bytes, snapshot
from namelens.plans.download import EXPORT_COLUMNS, export_projection
from namelens.plans.ingest import APPROVAL_KEYS


# Fixed value: the size limit of a single result file.
MAX_SINGLE_FILE_BYTES = 4_900_000_000


def _csv(df: DataFrame):
    return (
        df.write.mode("overwrite")
        .option("header", True)
        .option("compression", "gzip")
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", '""')
    )


def export_batch(
    rows: DataFrame, path: str, columns: Sequence[str], single_file: bool = False
) -> None:
    """Write one batch as gzipped CSV with a header: a folder of files, whatever its size.

    ``single_file`` asks for one file ``path`` instead. It is written by one task,
    so a batch beyond the size limit of such a file fails.
    """
    out = export_projection(rows, columns)
    if not single_file:
        _csv(out).csv(path)
        return
    out = snapshot(out, "export")
    if measured_bytes(out) > MAX_SINGLE_FILE_BYTES:
        raise ValueError("the batch is too large for a single file")
    # Beside its place, so that it is renamed and not copied.
    parts = f"{path}.parts"
    _csv(out.coalesce(1)).csv(parts)
    _move_part(rows.sparkSession, parts, path)


def _move_part(spark: SparkSession, folder: str, path: str) -> None:
    """Put the only part file of a folder in its place."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    source, target = hadoop.Path(folder), hadoop.Path(path)
    files = target.getFileSystem(conf)
    part = files.globStatus(hadoop.Path(f"{folder}/part-*"))[0].getPath()
    files.delete(target, True)
    if not files.rename(part, target):
        raise OSError(f"could not write {path}")
    files.delete(source, True)


def export_batches(
    rows: DataFrame, path: str, columns: Sequence[str] = EXPORT_COLUMNS
) -> None:
    """Write all batches in one job, one folder per organization and batch.

    The rebalance hint splits a very large batch over several files and puts
    small ones together in one task.
    """
    named = export_projection(rows, columns)
    keyed = rows.select(*APPROVAL_KEYS, *[c.lower() for c in columns]).toDF(
        *APPROVAL_KEYS, *named.columns
    )
    _csv(keyed.hint("rebalance", *APPROVAL_KEYS)).partitionBy(*APPROVAL_KEYS).csv(path)


# Rows of a result file; a larger batch gets several, each with a header.
ROWS_PER_FILE = 1_000_000


def _csv_value(value: Column) -> Column:
    """A value as the CSV writer writes it: quoted where it must be, null as nothing."""
    text = F.btrim(value.cast("string"), F.lit(" \t\r\n"))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    special = text.rlike('[",\r\n]') | (text == "")
    return F.when(value.isNull(), F.lit("")).when(special, quoted).otherwise(text)


def export_lists(rows: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write all batches, each row in the ``columns`` that its batch has ordered, in one job.

    A row becomes one line of text, so any number of column lists makes one plan
    and one write: gzipped CSV, one folder per organization and batch. Files of one
    batch go to different tasks, so every file gets one header and no more.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = F.create_map(*[x for c in EXPORT_COLUMNS for x in (F.lit(c), _csv_value(F.col(c.lower())))])
    line = F.array_join(F.transform("columns", lambda c: F.element_at(names, c)), ",")
    lines = rows.select(*APPROVAL_KEYS, "columns", line.alias("value"), F.xxhash64("record_id").alias("_hash"))
    # One row a batch.
    sizes = rows.groupBy(*APPROVAL_KEYS).agg(
        F.least(F.ceil(F.count(F.lit(1)) / rows_per_file), F.lit(tasks)).cast("int").alias("_files"),
        F.any_value("columns").alias("columns"),
    )
    sizes = snapshot(sizes, "files")
    body = lines.join(sizes.drop("columns"), APPROVAL_KEYS).select(
        *APPROVAL_KEYS, F.pmod("_hash", "_files").cast("int").alias("_file"), F.lit(1).alias("_body"), "value"
    )
    heads = sizes.select(
        *APPROVAL_KEYS,
        F.explode(F.sequence(F.lit(0), F.col("_files") - 1)).alias("_file"),
        F.lit(0).alias("_body"),
        F.array_join("columns", ",").alias("value"),
    )
    task = F.pmod(F.xxhash64(*APPROVAL_KEYS) + F.col("_file"), F.lit(tasks)).cast("int")
    (
        body.unionByName(heads)
        .repartitionById(tasks, task)
        .sortWithinPartitions(*APPROVAL_KEYS, "_body")
        .select(*APPROVAL_KEYS, "value")
        .write.mode("overwrite")
        .option("compression", "gzip")
        .partitionBy(*APPROVAL_KEYS)
        .text(path)
    )


def read_export(spark, path: str, columns: Sequence[str] = EXPORT_COLUMNS) -> DataFrame:
    """The exported files read back as text columns."""
    fields = ", ".join(f"{c} string" for c in [*columns, *APPROVAL_KEYS])
    return (
        spark.read.schema(fields).option("header", True).option("escape", '"').csv(path)
    )
