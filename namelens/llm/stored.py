"""Steps written to the shared folder, whose shuffle files go when they are written."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from namelens.operators.snapshot import passing_snapshot, snapshot

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of each query when it has ended, not at some later time."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once; a lost executor costs no more than its unfinished tasks."""
    with shuffles_freed(df.sparkSession):
        return snapshot(df, label)


@contextmanager
def stored_within(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``stored`` rows that are removed when the block ends; nothing lazy that reads them may leave it."""
    with shuffles_freed(df.sparkSession), passing_snapshot(df, label) as rows:
        yield rows


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import this package from where the driver has it.

    On a cluster the package is shipped as usual (``--py-files``), and this path
    is one more that is looked at.
    """
    own = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if own not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, own])
