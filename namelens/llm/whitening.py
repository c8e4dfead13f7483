"""Embeddings whitened by the eigenvectors of their covariance.

Entries become whole numbers on a grid, so that sums are exact and a common
offset of all entries costs no digits. The covariance is that of the different
vectors: each counts once, however often it is repeated. It is summed over
vectors that have been centred, block by block in the tasks and entry by entry
in Spark; only sums and the covariance, whose size is that of the dimension,
reach the driver. There they are split into components by spectral divide and
conquer (``qdwh``), and the components are sent to all tasks.

A row is left out if its vector is null, empty, or has null or non-finite entries.
Vectors of another length than most have no component either and are left out
too (of lengths equally frequent, the longer counts). Directions without variance
have no whitened value: there are at most as many components as the covariance
has rank, so none for a single vector or none at all. Repeated rows and rows
with a null id are kept, each with its own result. An entry beyond 2**46 on the
grid counts as 2**46. ``deviation`` is null where it does not fit into a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namelens.llm.qdwh import EPS, eigen
from namelens.llm.rows import kept_columns, packed, row_field, unpacked
from namelens.llm.stored import stored

# Grid points in a unit, and the offset that makes them positive.
GRID, OFFSET = 64, 1_000_000
# Farther from zero than this no entry is told from another.
FARTHEST = float(1 << 46)
COMPONENTS = 16
# Vectors that a task multiplies at once.
BLOCK = 4096
LONG_MAX = (1 << 63) - 1
ADDED = ["deviation", "whitened"]


def grid(vectors: np.ndarray) -> np.ndarray:
    """Distance on the grid from the offset, floor(64 c), for every entry."""
    return np.clip(np.floor(GRID * vectors.astype(np.float64)), -FARTHEST, FARTHEST).astype(np.int64)


def encoded(points: np.ndarray) -> list[bytes]:
    """Each row in the narrowest of 2, 4 or 8 bytes an entry that hold all of it; equal rows, equal bytes."""
    far = np.maximum(points.max(axis=1), -1 - points.min(axis=1)) if points.size else np.zeros(len(points))
    out = [b""] * len(points)
    for kind, low, high in (("<i2", -1, 1 << 15), ("<i4", 1 << 15, 1 << 31), ("<i8", 1 << 31, 1 << 63)):
        at = np.flatnonzero((far >= low) & (far < high))
        tag = kind[-1].encode()
        for i, row in zip(at.tolist(), points[at].astype(kind)):
            out[i] = tag + row.tobytes()
    return out


def decoded(rows: list[bytes], size: int) -> np.ndarray:
    """The rows of ``encoded`` again."""
    out = np.zeros((len(rows), size), dtype=np.int64)
    kinds = np.array([r[0] for r in rows], dtype=np.uint8)
    for kind in ("<i2", "<i4", "<i8"):
        at = np.flatnonzero(kinds == ord(kind[-1]))
        if len(at):
            data = b"".join([rows[i][1:] for i in at.tolist()])
            out[at] = np.frombuffer(data, dtype=kind).reshape(len(at), size)
    return out


def grid_points(vectors: DataFrame, column: str, passed: list[str]) -> DataFrame:
    """The ``passed`` columns with ``size`` and ``point``, for rows with a usable vector."""
    kept = [vectors.schema[c] for c in passed]
    schema = T.StructType([*kept, T.StructField("size", T.IntegerType()), T.StructField("point", T.BinaryType())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            lists = batch.column(column).cast(pa.list_(pa.float64()))
            sizes = np.array([-1 if s is None else s for s in pa.compute.list_value_length(lists).to_pylist()])
            for size in sorted(set(sizes[sizes > 0].tolist())):
                at = np.flatnonzero(sizes == size)
                for block in np.split(at, range(BLOCK, len(at), BLOCK)):
                    own = lists.take(pa.array(block))
                    flat = own.flatten().to_numpy(zero_copy_only=False).reshape(len(block), size)
                    # A null entry is not a number here.
                    good = np.isfinite(flat).all(axis=1)
                    rows = pa.array(block[good])
                    columns = [batch.column(f.name).take(rows) for f in kept]
                    points = encoded(grid(flat[good]))
                    columns += [pa.array([size] * len(points), pa.int32()), pa.array(points, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return vectors.mapInArrow(run, schema)


@dataclass
class Whitening:
    """What is learned from the different vectors; all arrays have the vectors' dimension."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def size(self) -> int:
        return len(self.sums)

    def centred(self, points: np.ndarray) -> np.ndarray:
        """Points less their mean; the difference is formed in whole numbers where they hold it."""
        near = np.array([s // self.n for s in self.sums], dtype=np.int64)
        left = np.array([(s % self.n) / self.n for s in self.sums])
        return (points - near) - left

    def whitened(self, points: np.ndarray) -> np.ndarray:
        return self.centred(points) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, points: np.ndarray) -> list[int | None]:
        """The sum of (n x - S)**2 of each row, exact; the offset cancels out."""
        reach = self.n * int(np.abs(points).max(initial=0)) + max(map(abs, self.sums), default=0)
        if reach * reach * self.size <= LONG_MAX:
            far = points * self.n - np.array(self.sums, dtype=np.int64)
            return (far * far).sum(axis=1).tolist()
        exact = [sum((self.n * x - s) ** 2 for x, s in zip(row, self.sums)) for row in points.tolist()]
        return [v if v <= LONG_MAX else None for v in exact]


def blocks(points: pa.Array, size: int) -> Iterator[np.ndarray]:
    for start in range(0, len(points), BLOCK):
        yield decoded(points.slice(start, BLOCK).to_pylist(), size)


def summed_products(points: DataFrame, size: int, centred, width: int) -> np.ndarray:
    """The sum of z z^T over all points, z the ``centred`` point of ``width`` entries."""
    upper = np.triu_indices(width)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in parts:
            for block in blocks(batch.column("point"), size):
                z = centred(block)
                total += z.T @ z
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(upper[0])), pa.int32()), pa.array(total[upper])], ["cell", "part"]
        )

    cells = points.select("point").mapInArrow(run, "cell int, part double").groupBy("cell")
    # As many numbers as the matrix has, whatever the number of vectors.
    found = cells.agg(F.sum("part").alias("total")).toArrow()
    out = np.zeros((width, width))
    cell = found["cell"].to_numpy()
    out[upper[0][cell], upper[1][cell]] = found["total"].to_numpy()
    return out + np.triu(out, 1).T


def fit(points: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learn from the different points of the prevailing length; None without any."""
    lengths = points.groupBy("size").agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return None
    size = most["size"]
    different = stored(points.where(F.col("size") == size).select("point").distinct(), "different-points")

    def added(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * size
        for batch in parts:
            n += batch.num_rows
            for block in blocks(batch.column("point"), size):
                total = [a + b for a, b in zip(total, block.sum(axis=0).tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size + 1), pa.int32()), pa.array([str(t) for t in [*total, n]])], ["place", "part"]
        )

    parts = different.mapInArrow(added, "place int, part string")
    found = parts.groupBy("place").agg(F.sum(F.col("part").cast("decimal(28,0)")).alias("total"))
    totals = {r["place"]: int(r["total"]) for r in found.collect()}
    n = totals.pop(size)
    model = Whitening(n, [totals[i] for i in range(size)], np.eye(size), np.ones(size), 0.0)
    covariance = summed_products(different, size, model.centred, size) / n
    values, vectors = eigen(covariance)
    rank = int((values > size * EPS * max(values[0], 0.0)).sum()) if n > 1 else 0
    kept = min(components, rank)
    model.values, model.vectors, model.trace = values[:kept], vectors[:, :kept], float(np.trace(covariance))
    if kept:
        white = summed_products(different, size, model.whitened, kept) / n
        model.identity_error = float(np.abs(white - np.eye(kept)).max())
    return model


def whiten(
    vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS
) -> tuple[DataFrame, Whitening | None]:
    """The usable rows with ``deviation`` and ``whitened`` (one number a component), and what was learned.

    Added columns replace columns of the same name; all others are kept as they are.
    """
    rows = packed(vectors, [column], ADDED)
    points = stored(grid_points(rows, column, ["_row"]), "points")
    model = fit(points.select("size", "point"), components)
    schema = T.StructType(
        [
            row_field(vectors, ADDED),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.ArrayType(T.DoubleType(), False)),
        ]
    )
    if model is None:
        none = points.select("_row", F.lit(None).cast("bigint").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
        return unpacked(none, kept_columns(vectors, ADDED), {n: F.col(n) for n in ADDED}), None
    sent = vectors.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in parts:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                block = decoded(part.column("point").to_pylist(), own.size)
                white = own.whitened(block)
                offsets = np.arange(len(block) + 1, dtype=np.int32) * white.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_row"),
                        pa.array(own.deviations(block), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(white.ravel())),
                    ],
                    schema.fieldNames(),
                )

    out = points.where(F.col("size") == model.size).select("_row", "point").mapInArrow(run, schema)
    return unpacked(out, kept_columns(vectors, ADDED), {n: F.col(n) for n in ADDED}), model


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitened components of every usable embedding."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    white, model = whiten(rows)
    n, error, shares = 0, 0.0, []
    if model is not None:
        n, error, shares = model.n, model.identity_error, (model.values / model.trace).tolist()
    explained = F.array(*[F.lit(s) for s in shares]).cast("array<double>")
    return white.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "value")).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
