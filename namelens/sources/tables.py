"""Parquet tables that the jobs read, replace and append to.

Small tables get a new version folder when they are replaced and are read from the
newest complete one. Tables with a row per person are stored in parts by batch,
queues and other tables that grow with the batches in parts by the hash of their
key (``parts``); a run reads and rewrites the parts that it touches. So a job never
overwrites what it reads and a failed write is never seen. What is replaced stays
until ``vacuum`` removes what has a given age. Inserted rows are written aside and
moved into place whole, so a stream never sees half a run. There may be one writer
per root at a time.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namelens import schemas
from namelens.sources.parts import Buckets, Folders, Parts

# Keyed tables: those in BUCKETED in parts, the others replaced as a whole.
KEYED = {
    "client": schemas.CLIENT,
    "client_batch": schemas.BATCH,
    "approval_queue": schemas.APPROVAL_QUEUE,
    "enrichment_status": schemas.ENRICHMENT_STATUS,
    "completion_queue": schemas.COMPLETION_QUEUE,
    "download_queue": schemas.DOWNLOAD_QUEUE,
    "download_ready_queue": schemas.DOWNLOAD_READY_QUEUE,
    "outbox": schemas.OUTBOX,
    "output_configuration": schemas.OUTPUT_CONFIGURATION,
    "enrichment_attribute": schemas.ATTRIBUTE,
    "enrichment_attribute_detail": schemas.ATTRIBUTE_DETAIL,
    "gender_metrics": schemas.METRICS,
    "landed_file": schemas.LANDED_FILE,
    "derived_from": schemas.DERIVED_FROM,
    "name_counts": schemas.NAME_COUNTS,
    "name_count_stage": None,
    "voter_roll": None,
    "voter_stage": None,
    "voter_gender_lookup": None,
    "gender_lookup": None,
    "age_lookup_generic": None,
    "age_lookup_specific": None,
}

# The key columns by whose hash a keyed table is stored in parts.
BUCKETED = {
    "client_batch": ["client_id", "id"],
    "approval_queue": ["app_organization_id", "app_batch_id"],
    "enrichment_status": ["client_id", "batch_id"],
    "completion_queue": ["client_id", "batch_id"],
    "download_ready_queue": ["app_organization_id", "app_batch_id"],
    "outbox": ["client_id", "batch_id"],
    "gender_metrics": ["client_id", "batch_id"],
    "landed_file": ["app_organization_id", "app_batch_id"],
}
# Parts of such a table; one number for all of a root's life.
BUCKETS = 16
BUCKET = "_bucket"

# Tables with a row per person, stored per batch and rewritten per batch.
PER_BATCH = {
    "person_input": schemas.PERSON_INPUT,
    "gender_results": schemas.GENDER_RESULTS,
    "age_results_expanded": schemas.AGE_RESULTS,
    "age_results_collapsed": schemas.AGE_RESULTS,
    "improvement_store": schemas.IMPROVEMENT_STORE,
    "person_clean": schemas.PERSON_CLEAN,
    "gender_baseline": schemas.GENDER_BASELINE,
    "age_baseline_expanded": schemas.AGE_BASELINE,
    "age_baseline_collapsed": schemas.AGE_BASELINE,
}

# Folders of inserted rows, one sub-folder per writing run; streams follow them.
CHANGES = {
    "landing": schemas.LANDING,
    "approval_queue": schemas.APPROVAL_QUEUE,
    "approval_results": schemas.APPROVAL_RESULTS,
    "enrichment_status": schemas.ENRICHMENT_STATUS,
    "completion_queue": schemas.COMPLETION_QUEUE,
    "download_queue": schemas.DOWNLOAD_QUEUE,
    "download_ready_queue": schemas.DOWNLOAD_READY_QUEUE,
    "outbox": schemas.OUTBOX,
}

BATCH_PARTITIONS = ["client_id", "batch_id"]
FILE = "_file"


def file_key(name: Column) -> Column:
    """The folder name of an uploaded file's landed rows."""
    return F.sha1(F.coalesce(name, F.lit("")).cast("binary"))


class Tables:
    """The tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.folders = Folders(spark)

    def version(self, name: str) -> int:
        """How often a table that is replaced as a whole has been written."""
        return max(self.folders.versions(f"{self.root}/keyed/{name}"), default=0)

    def has(self, name: str) -> bool:
        """Whether a keyed table has been written."""
        return self._bucketed(name).written() if name in BUCKETED else bool(self.version(name))

    def _bucketed(self, name: str) -> Buckets:
        schema = T.StructType([*schemas.struct(KEYED[name]).fields, T.StructField(BUCKET, T.StringType())])
        return Buckets(self.spark, f"{self.root}/keyed/{name}", schema, BUCKET)

    def _with_bucket(self, name: str, df: DataFrame) -> DataFrame:
        """The part of a row. The number of parts is in its name: a root keeps the number it began with."""
        number = F.pmod(F.xxhash64(*BUCKETED[name]), F.lit(self.buckets))
        return df.withColumn(BUCKET, F.concat(number.cast("string"), F.lit(f"-{self.buckets}")))

    def _touched(self, name: str, keys: DataFrame) -> set[str]:
        """The parts that some keys are in: at most as many names as there are parts."""
        return {r[0] for r in self._with_bucket(name, keys).select(BUCKET).distinct().collect()}

    def read(self, name: str, keys: DataFrame | None = None) -> DataFrame:
        """The newest rows of a keyed table, or an empty one.

        With ``keys`` the rows of the parts that those keys are in: all that have
        such a key, and some more.
        """
        if name in BUCKETED:
            touched = None if keys is None else self._touched(name, keys)
            return self._bucketed(name).read(touched)
        path = f"{self.root}/keyed/{name}"
        version = self.version(name)
        if not version:
            if KEYED[name] is None:
                raise LookupError(f"table {name} has not been loaded")
            return self.spark.createDataFrame([], schemas.struct(KEYED[name]))
        reader = self.spark.read
        if KEYED[name]:
            reader = reader.schema(schemas.struct(KEYED[name]))
        return reader.parquet(f"{path}/version={version}")

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        """Write a keyed table anew and return it."""
        if name in BUCKETED:
            return self._bucketed(name).replace(self._with_bucket(name, df), whole=True)
        path = f"{self.root}/keyed/{name}"
        if KEYED[name]:
            df = df.select(
                *[F.col(f.name).cast(f.dataType) for f in schemas.struct(KEYED[name]).fields]
            )
        df.write.mode("overwrite").parquet(f"{path}/version={self.version(name) + 1}")
        return self.read(name)

    def change(self, name: str, keys: DataFrame, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Change the rows with the given ``keys`` and return the rows of their parts.

        ``make`` takes the rows of those parts and returns all of them, changed; it
        must leave keys as they are and may add rows with one of ``keys``. Other
        parts are neither read nor written.
        """
        table = self._bucketed(name)
        touched = self._touched(name, keys)
        changed = make(table.read(touched))
        return table.replace(self._with_bucket(name, changed))

    def vacuum(self, older_than_seconds: float) -> int:
        """Remove what was replaced or never published; returns how many folders.

        A version or part goes only if it was replaced that long ago, so a reader
        that has held it for less is safe. To be run by hand or on a schedule.
        """
        now, removed = time.time(), 0
        for name in KEYED:
            if name in BUCKETED:
                removed += self._bucketed(name).vacuum(older_than_seconds)
                continue
            path = f"{self.root}/keyed/{name}"
            versions, changed = self.folders.versions(path), self.folders.names(path)
            for old, new in zip(versions, versions[1:]):
                if now - changed[f"version={new}"] >= older_than_seconds:
                    self.folders.remove(f"{path}/version={old}")
                    removed += 1
        for name in PER_BATCH:
            removed += self.people(name).vacuum(older_than_seconds)
        return removed

    def people(self, name: str) -> Parts:
        """A table with a row per person, in parts by batch."""
        return Parts(self.spark, f"{self.root}/people/{name}", schemas.struct(PER_BATCH[name]), BATCH_PARTITIONS)

    def read_people(self, name: str, keys: DataFrame | None = None) -> DataFrame:
        """A per-batch table, or only the rows of the batches in ``keys``.

        The batches of a run are read from their folders alone, however many they
        are, so the rest of the table is not even listed.
        """
        return self.people(name).read(keys)

    def replace_people(self, name: str, df: DataFrame) -> None:
        """Replace the batches that are in ``df``; all other batches stay untouched."""
        self.people(name).replace(df)

    def drop_batches(self, name: str, keys: DataFrame) -> None:
        """Remove whole batches of a per-batch table."""
        self.people(name).drop(keys)

    def change_path(self, name: str) -> str:
        return f"{self.root}/changes/{name}"

    def _complete(self, path: str) -> bool:
        return self.folders.exists(f"{path}/_SUCCESS")

    def _write_once(self, path: str, df: DataFrame, ddl: str, by: Column | None = None) -> None:
        if self._complete(path):
            return
        have = set(df.columns)
        out = df.select(
            *[
                (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schemas.struct(ddl).fields
            ]
        )
        # Written aside and moved: whoever lists the folder sees all of it or nothing.
        aside = f"{self.root}/writing/{uuid.uuid4().hex}"
        if by is None:
            out.write.parquet(aside)
        else:
            out.withColumn(FILE, by).hint("rebalance", FILE).write.partitionBy(FILE).parquet(aside)
        fs, target, make = self.folders.at(path)
        fs.delete(target, True)
        fs.mkdirs(target.getParent())
        if not fs.rename(make(aside), target):
            raise OSError(f"could not move the rows into {path}")

    def stage(self, run: str, name: str, df: DataFrame, ddl: str) -> DataFrame:
        """The new rows of a run, written once: repeating the run gives the same rows."""
        path = f"{self.root}/staged/{run}/{name}"
        self._write_once(path, df, ddl)
        return self.spark.read.schema(schemas.struct(ddl)).parquet(path)

    def emit(self, name: str, df: DataFrame, run: str) -> None:
        """Add inserted rows for the streams; repeating the run adds nothing.

        Landed rows get a folder for each uploaded file, so that one can go alone.
        """
        by = file_key(F.col("storage_file_name")) if name == "landing" else None
        self._write_once(f"{self.change_path(name)}/{run}", df, CHANGES[name], by)

    def changes(self, name: str) -> DataFrame:
        """All rows inserted so far and not dropped."""
        schema = schemas.struct(CHANGES[name])
        path = self.change_path(name)
        if not self.folders.exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)

    def change_stream(self, name: str, max_files: int | None = None) -> DataFrame:
        """The inserted rows as a stream. Updates of the keyed table never appear here."""
        fs, target, _ = self.folders.at(self.change_path(name))
        fs.mkdirs(target)
        reader = self.spark.readStream.schema(schemas.struct(CHANGES[name]))
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.option("recursiveFileLookup", True).parquet(self.change_path(name))

    def drop_landed(self, files: set[str]) -> None:
        """Remove the landed rows of some files, given by their ``file_key``; no row is read.

        The folders are listed, as the stream that follows them does.
        """
        path = self.change_path("landing")
        for run in self.folders.names(path):
            inside = {n for n in self.folders.names(f"{path}/{run}") if n.startswith(f"{FILE}=")}
            gone = {n for n in inside if n.split("=")[1] in files}
            if gone and gone == inside:
                self.folders.remove(f"{path}/{run}")
                continue
            for name in gone:
                self.folders.remove(f"{path}/{run}/{name}")
