"""Steps written once to the shared folder and read back.

A written step cuts the lineage, survives the loss of any executor and has a
size that can be measured instead of guessed.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_local_dirs: dict[str, str] = {}
_written: ContextVar[list[str] | None] = ContextVar("snapshots", default=None)


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session that
    names none gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    checkpoint_dir = context.getCheckpointDir()
    if checkpoint_dir:
        return checkpoint_dir
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="namelens-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{scratch_dir(spark)}/namelens/{label}-{uuid.uuid4().hex}"


@contextmanager
def temporary_snapshots(spark: SparkSession) -> Iterator[None]:
    """Remove the snapshots made inside the block when it ends.

    For jobs that write their results: nothing lazy may leave the block.
    """
    paths: list[str] = []
    token = _written.set(paths)
    try:
        yield
    finally:
        _written.reset(token)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            target = hadoop.Path(path)
            target.getFileSystem(conf).delete(target, True)


def snapshot(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` once and return the stored rows."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    written = _written.get()
    if written is not None:
        written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing_snapshot(df: DataFrame, label: str = "step") -> Iterator[DataFrame]:
    """The rows of ``df``, stored until the block ends; snapshots made inside the block stay."""
    outer = _written.get()
    with temporary_snapshots(df.sparkSession):
        rows = snapshot(df, label)
        token = _written.set(outer)
        try:
            yield rows
        finally:
            _written.reset(token)


def measured_bytes(df: DataFrame) -> int:
    """An upper estimate of the in-memory size of ``df`` from its actual rows.

    One distributed aggregate; call it on stored data.
    """
    fixed = 32 + 16 * len(df.columns)
    texts = []
    for field in df.schema.fields:
        name = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            texts.append(F.coalesce(F.octet_length(name), F.lit(0)))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            texts.append(F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0)))
    text_bytes = sum((t.cast("bigint") for t in texts), F.lit(0).cast("bigint"))
    row = df.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(text_bytes), F.lit(0)).alias("b")
    ).first()
    return row["n"] * fixed + row["b"]
