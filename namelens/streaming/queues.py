"""Streams that wake the jobs: each handles every inserted row once, in order of arrival."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from namelens.operators import temporary_snapshots
from namelens.sources.files import read_client_csv, to_landing
from namelens.sources.tables import Tables

Handler = Callable[[DataFrame, str], object]

ONCE = {"availableNow": True}
EVERY_10_SECONDS = {"processingTime": "10 seconds"}


def run_name(rows: DataFrame, name: str, epoch: int) -> str:
    """The same for a repeated run, different for a stream with a new checkpoint."""
    stream = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{name}-{stream}-{epoch}"


def start_ingest(
    spark: SparkSession,
    tables: Tables,
    uploads: str,
    checkpoint: str,
    trigger: dict | None = None,
    now: Callable[[], Column] = F.current_timestamp,
    quote: str = '"',
    max_files: int | None = None,
) -> StreamingQuery:
    """Land every new upload file. A file is landed as a whole, once.

    ``max_files`` bounds how many files one run takes.
    """

    def land(files: DataFrame, epoch: int) -> None:
        if files.isEmpty():
            return
        landed = to_landing(files, now().cast("timestamp_ntz"))
        tables.emit("landing", landed, run_name(files, "landing", epoch))

    stream = read_client_csv(spark, uploads, stream=True, quote=quote, max_files=max_files)
    return (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ONCE))
        .start()
    )


def start_queue(
    tables: Tables,
    name: str,
    handler: Handler,
    checkpoint: str,
    trigger: dict | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Call ``handler(rows, run)`` with the rows inserted into a table since the last call.

    No rows, no call. The rows of a call are a fixed set of files, so all of the
    handler's steps see the same ones; nothing is copied. After a failure the same
    rows come again under the same run name.
    """

    def run(rows: DataFrame, epoch: int) -> None:
        if rows.isEmpty():
            return
        with temporary_snapshots(tables.spark):
            handler(rows, run_name(rows, name, epoch))

    return (
        tables.change_stream(name, max_files)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ONCE))
        .start()
    )
