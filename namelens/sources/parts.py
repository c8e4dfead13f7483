"""Tables stored in parts that are replaced one by one.

Every write goes to a folder of its own, and a pointer names for each part the
write that holds it. A new version of the pointer is the one step that publishes a
write: what is read and what is written never coincide, a job that dies before that
step has changed nothing, and parts that it did not touch are neither read nor
written. Replaced folders stay until ``vacuum``.

``Parts`` may have any number of parts; their pointer is a table. ``Buckets`` have
a fixed number; theirs is a small file that the driver reads.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WRITE, MADE_FROM = "_write", "_made_from"


class Folders:
    """What the tables do with folders, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def at(self, path: str):
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return target.getFileSystem(conf), target, jvm.org.apache.hadoop.fs.Path

    def exists(self, path: str) -> bool:
        fs, target, _ = self.at(path)
        return fs.exists(target)

    def names(self, path: str) -> dict[str, float]:
        """What lies in a folder, with the seconds at which it last changed."""
        fs, target, _ = self.at(path)
        if not fs.exists(target):
            return {}
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in fs.listStatus(target)}

    def remove(self, path: str) -> None:
        fs, target, _ = self.at(path)
        fs.delete(target, True)

    def versions(self, path: str) -> list[int]:
        """The complete versions of a table, oldest first."""
        found = [n for n in self.names(path) if n.startswith("version=")]
        return sorted(int(n.split("=")[1]) for n in found if self.exists(f"{path}/{n}/_SUCCESS"))


    def read_text(self, path: str) -> str:
        fs, target, _ = self.at(path)
        stream = fs.open(target)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Write a small file that is there whole or not at all."""
        aside = f"{path}.{uuid.uuid4().hex}"
        fs, target, make = self.at(path)
        stream = fs.create(make(aside))
        stream.write(bytearray(text.encode()))
        stream.close()
        if not fs.rename(make(aside), target):
            raise OSError(f"could not write {path}")


def local_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A short list of rows, which needs no task to be read."""
    kinds = {T.LongType: pa.int64(), T.StringType: pa.string()}
    columns = [pa.array([r[i] for r in rows], kinds[type(f.dataType)]) for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema.fieldNames()), schema)


class Parts:
    """A table whose parts are told by the ``by`` columns, below ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str]):
        self.spark, self.path, self.schema, self.by = spark, path, schema, list(by)
        self.folders = Folders(spark)
        keys = [T.StructField(c, schema[c].dataType) for c in self.by]
        self.keys = T.StructType(keys)
        self.pointers = T.StructType([*keys, T.StructField(WRITE, T.StringType()), T.StructField(MADE_FROM, T.StringType())])

    def written(self) -> bool:
        return bool(self.folders.versions(f"{self.path}/pointer"))

    def pointer(self) -> DataFrame:
        """One row a part: its keys, the write that holds it and what it was made from."""
        versions = self.folders.versions(f"{self.path}/pointer")
        if not versions:
            return self.spark.createDataFrame([], self.pointers)
        return self.spark.read.schema(self.pointers).parquet(f"{self.path}/pointer/version={versions[-1]}")

    def _point(self, rows: DataFrame) -> None:
        """Publish: from here on readers find the parts that ``rows`` names."""
        version = max(self.folders.versions(f"{self.path}/pointer"), default=0) + 1
        rows = rows.select(*self.pointers.fieldNames())
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/pointer/version={version}")

    def _folder(self, row) -> str:
        inner = "/".join(f"{c}={row[c]}" for c in self.by)
        return f"{self.path}/data/{WRITE}={row[WRITE]}/{inner}"

    def read(self, keys: DataFrame | None = None) -> DataFrame:
        """All rows, or those of the parts in ``keys``.

        Of a key list only the folders are listed and read, however many parts the
        table has; the driver holds the keys of those parts.
        """
        columns = self.schema.fieldNames()
        pointer = self.pointer()
        wanted = T.StructType([*self.schema.fields, T.StructField(WRITE, T.StringType())])
        reader = self.spark.read.schema(wanted).option("basePath", f"{self.path}/data")
        if keys is None:
            if not self.folders.exists(f"{self.path}/data"):
                return self.spark.createDataFrame([], self.schema)
            # Folders that no pointer names, or no longer, are there as well.
            rows = reader.parquet(f"{self.path}/data")
            live = pointer.select(*self.by, WRITE)
            return rows.join(live, [*self.by, WRITE], "left_semi").select(*columns)
        asked = keys.select(*self.by).distinct()
        found = pointer.join(F.broadcast(asked), self.by, "left_semi").select(*self.by, WRITE).collect()
        if not found:
            return self.spark.createDataFrame([], self.schema)
        return reader.parquet(*[self._folder(r) for r in found]).select(*columns)

    def replace(self, df: DataFrame, made_from: DataFrame | None = None, whole: bool = False) -> DataFrame:
        """Replace the parts that are in ``df``, or with ``whole`` the table by them; returns the new rows.

        ``made_from`` has a row a part that says what it was made from. The
        rebalance hint spreads a very large part over several files. The driver
        lists the folders of the new parts.
        """
        write = uuid.uuid4().hex
        folder = f"{self.path}/data/{WRITE}={write}"
        out = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        out.hint("rebalance", *self.by).write.partitionBy(*self.by).parquet(folder)
        rows = [(*self._key_of(part, folder), write, None) for part in self._part_folders(folder, len(self.by))]
        new = local_rows(self.spark, rows, self.pointers)
        if made_from is not None:
            new = new.drop(MADE_FROM).join(made_from.select(*self.by, MADE_FROM), self.by, "left")
        if not whole:
            named = local_rows(self.spark, rows, self.keys)
            old = self.pointer().join(F.broadcast(named), self.by, "left_anti")
            new = old.unionByName(new)
        self._point(new)
        if not rows:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.schema).option("basePath", folder)
        return reader.parquet(folder).select(*self.schema.fieldNames())

    def _key_of(self, part: str, folder: str) -> tuple:
        values = [unquote(level.split("=", 1)[1]) for level in part.removeprefix(f"{folder}/").split("/")]
        return tuple(int(v) if isinstance(f.dataType, T.LongType) else v for v, f in zip(values, self.keys.fields))

    def drop(self, keys: DataFrame) -> None:
        """Take parts out of the table, then remove their folders."""
        pointer = self.pointer()
        asked = keys.select(*self.by).distinct()
        gone = pointer.join(asked, self.by, "left_semi").select(*self.by, WRITE).collect()
        if not gone:
            return
        self._point(pointer.join(asked, self.by, "left_anti"))
        for row in gone:
            self.folders.remove(self._folder(row))

    def vacuum(self, older_than_seconds: float) -> int:
        """Remove replaced and never published folders, and old pointers; returns how many.

        What a pointer named until so long ago stays, so a reader that has held it
        for less is safe.
        """
        now, versions = time.time(), self.folders.versions(f"{self.path}/pointer")
        ages = self.folders.names(f"{self.path}/pointer")
        kept, removed = versions[-1:], 0
        for old, new in zip(versions, versions[1:]):
            if now - ages[f"version={new}"] < older_than_seconds:
                kept.append(old)
        live: set[str] = set()
        reader = self.spark.read.schema(self.pointers)
        if kept:
            rows = reduce(DataFrame.union, [reader.parquet(f"{self.path}/pointer/version={v}") for v in kept])
            live = {self._folder(r) for r in rows.select(*self.by, WRITE).distinct().collect()}
        writes = {f.split(f"/{WRITE}=")[1].split("/")[0] for f in live}
        for name, changed in self.folders.names(f"{self.path}/data").items():
            folder = f"{self.path}/data/{name}"
            if now - changed < older_than_seconds or not name.startswith(f"{WRITE}="):
                continue
            if name.split("=")[1] not in writes:
                self.folders.remove(folder)
                removed += 1
                continue
            for part in self._part_folders(folder, len(self.by)):
                if part not in live:
                    self.folders.remove(part)
                    removed += 1
        for version in set(versions) - set(kept):
            self.folders.remove(f"{self.path}/pointer/version={version}")
            removed += 1
        return removed

    def _part_folders(self, folder: str, depth: int) -> list[str]:
        if depth == 0:
            return [folder]
        below = [f"{folder}/{n}" for n in self.folders.names(folder) if "=" in n]
        return [part for f in below for part in self._part_folders(f, depth - 1)]


class Buckets:
    """A table of a fixed number of parts, told by a string column ``by``, below ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, by: str):
        self.spark, self.path, self.schema, self.by = spark, path, schema, by
        self.folders = Folders(spark)

    def _versions(self) -> list[int]:
        names = self.folders.names(f"{self.path}/pointer")
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("version=") and n.split("=")[1].isdigit())

    def written(self) -> bool:
        return bool(self._versions())

    def pointer(self, version: int | None = None) -> dict[str, str]:
        """The write that holds each part."""
        version = version or max(self._versions(), default=0)
        return json.loads(self.folders.read_text(f"{self.path}/pointer/version={version}")) if version else {}

    def _point(self, pointer: dict[str, str]) -> None:
        version = max(self._versions(), default=0) + 1
        self.folders.write_text(f"{self.path}/pointer/version={version}", json.dumps(pointer))

    def _folder(self, part: str, write: str) -> str:
        return f"{self.path}/data/{WRITE}={write}/{self.by}={part}"

    def read(self, parts: set[str] | None = None) -> DataFrame:
        """All rows, or those of some parts."""
        pointer = self.pointer()
        folders = [self._folder(p, w) for p, w in sorted(pointer.items()) if parts is None or p in parts]
        plain = T.StructType([f for f in self.schema.fields if f.name != self.by])
        if not folders:
            return self.spark.createDataFrame([], plain)
        return self.spark.read.schema(plain).parquet(*folders)

    def replace(self, df: DataFrame, whole: bool = False) -> DataFrame:
        """Replace the parts that are in ``df``, or with ``whole`` the table by them; returns the new rows."""
        write = uuid.uuid4().hex
        folder = f"{self.path}/data/{WRITE}={write}"
        out = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        out.hint("rebalance", self.by).write.partitionBy(self.by).parquet(folder)
        found = [n.split("=", 1)[1] for n in self.folders.names(folder) if n.startswith(f"{self.by}=")]
        self._point({**({} if whole else self.pointer()), **dict.fromkeys(found, write)})
        return self.read(set(found))

    def vacuum(self, older_than_seconds: float) -> int:
        """As that of ``Parts``."""
        now, versions, removed = time.time(), self._versions(), 0
        ages = self.folders.names(f"{self.path}/pointer")
        kept = versions[-1:] + [
            old for old, new in zip(versions, versions[1:]) if now - ages[f"version={new}"] < older_than_seconds
        ]
        live = {self._folder(p, w) for v in kept for p, w in self.pointer(v).items()}
        for name, changed in self.folders.names(f"{self.path}/data").items():
            if now - changed < older_than_seconds:
                continue
            folder = f"{self.path}/data/{name}"
            parts = {f"{folder}/{n}" for n in self.folders.names(folder) if n.startswith(f"{self.by}=")}
            gone = [folder] if not parts & live else sorted(parts - live)
            for path in gone:
                self.folders.remove(path)
            removed += len(gone)
        for version in set(versions) - set(kept):
            self.folders.remove(f"{self.path}/pointer/version={version}")
            removed += 1
        return removed
