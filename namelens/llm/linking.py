"""Links between members of common buckets, and the groups that links connect.

Similarity operators put equal-looking members into common buckets and verify
pairs. A bucket may hold a third of all members, so no pairs are listed within
it. First every member is compared with its bucket's least member only. What is
linked then forms groups; only in buckets whose members are still in different
groups are the members of different groups compared with each other. Every pair
in a bucket is thus verified, or its members are in one group already.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namelens.llm.stored import stored
from namelens.operators.snapshot import measured_bytes

# Tables up to this size are sent to all tasks; larger ones are joined by a shuffle.
BROADCAST_BYTES = 32 * 1024 * 1024
# Members are shuffled by bucket in so many rounds, each with its share of the buckets.
ROUNDS = 8
# Packed buckets are dealt out in so many rounds, in parts of about so many; a pack has this many of all parts.
PACK_ROUNDS = 4
PART_ENTRIES = 500_000
PACK_ENTRIES = 1 << 18
OUT_ROWS = 1 << 16
BUCKETS = [f"buckets_{n}" for n in range(PACK_ROUNDS)]


def components(edges: DataFrame) -> DataFrame:
    """Connected groups of (a, b) edges: one row (node, root) for each node, root the least node.

    Alternating large and small stars: each round hangs the larger neighbours of
    a node, then the smaller ones, on the least of them, until nothing changes.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v")
    edges = stored(edges.distinct(), "edges")
    before = None
    while True:
        seen = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.max("u")).first()
        if seen == before or not seen[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct()
            )
        before = seen
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        edges = stored(edges, "large-stars")
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        hung = edges.join(least, "u")
        edges = stored(
            hung.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(hung.select("u", "m")).distinct(),
            "small-stars",
        )


def linked_groups(
    members: DataFrame,
    near: Callable[[Column, Column], Column],
    verified: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Groups of the ids of ``members`` (bucket, id, trait), as (node, root).

    An id has one trait and is in a bucket once.

    ``near`` tells from two traits whether a pair is worth verifying; it must hold
    for every true link. ``verified`` keeps the true links of distinct (a, b) rows.
    Ids without a link are not among the nodes.
    """
    # Most buckets hold one member and go before anything else is shuffled. The
    # buckets are taken in rounds, so that one round's shuffle files are gone
    # before the next one writes its own.
    parts = []
    for round_ in range(ROUNDS):
        own = members.where(F.pmod(F.col("bucket"), F.lit(ROUNDS)) == round_)
        heads = own.groupBy("bucket").agg(F.min("id").alias("head"), F.max("id").alias("_last"))
        heads = stored(heads.where("head < _last").select("bucket", "head"), "heads")
        small = measured_bytes(heads) <= BROADCAST_BYTES
        parts.append(stored(own.join(F.broadcast(heads) if small else heads, "bucket"), "shared-buckets"))
    shared = reduce(DataFrame.union, parts)
    head_traits = shared.where("id = head").select("bucket", F.col("trait").alias("head_trait"))
    pairs = (
        shared.where("id > head")
        .join(head_traits, "bucket")
        .where(near(F.col("trait"), F.col("head_trait")))
        .select(F.col("id").alias("a"), F.col("head").alias("b"))
        .distinct()
    )
    return _groups_of_shared(shared, pairs, near, verified)


def bucket_columns(buckets: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
    """The well mixed 64-bit buckets ``ends[i]:ends[i + 1]`` of each row as bytes, in a column for each round."""
    columns = []
    for round_ in range(PACK_ROUNDS):
        own = buckets % np.uint64(PACK_ROUNDS) == round_
        own_ends = np.concatenate(([0], np.cumsum(own)))[ends] * buckets.itemsize
        data = [None, pa.py_buffer(own_ends.astype(np.int32)), pa.py_buffer(buckets[own])]
        columns.append(pa.Array.from_buffers(pa.binary(), len(ends) - 1, data))
    return columns


def _bucket_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the buckets of each row end, and the buckets of all rows."""
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    held = data[int(ends[0]) : int(ends[-1])] if data is not None else b""
    return ends // 8, np.frombuffer(held, dtype=np.uint64)


def shared_buckets(members: DataFrame) -> DataFrame:
    """The members of buckets with two different ids or more, as (bucket, id, head, n).

    ``head`` is the least id of the bucket, ``n`` the number of its ids.

    ``members`` has ``id`` and the columns of ``bucket_columns``. An id may come in
    several rows. Buckets and ids are dealt out in packs, a row for each task and
    part, and are sorted as arrays.
    """
    spark = members.sparkSession
    entries = (members.agg(F.sum(sum((F.octet_length(c) for c in BUCKETS), F.lit(0)))).first()[0] or 0) // 8
    parts = -(-max(1, entries) // (PACK_ROUNDS * PART_ENTRIES))

    def dealt(round_: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def pack(held: list[np.ndarray]) -> pa.RecordBatch:
            rows = np.concatenate(held)
            # The lowest bits tell the round, the high half tells the part.
            part = ((rows[:, 0] >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            part = part.astype(np.uint16 if parts < 1 << 16 else np.uint32)
            rows = np.ascontiguousarray(rows[np.argsort(part, kind="stable")])
            counts = np.bincount(part, minlength=parts)
            filled = np.flatnonzero(counts)
            ends = np.concatenate(([0], np.cumsum(counts[filled]))) * rows.itemsize * 2
            packs = pa.Array.from_buffers(
                pa.binary(), len(filled), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(rows)]
            )
            return pa.RecordBatch.from_arrays([pa.array(filled.astype(np.int32)), packs], ["part", "entries"])

        def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for batch in batches_:
                ends, buckets = _bucket_arrays(batch.column(BUCKETS[round_]))
                ids = np.repeat(batch.column("id").to_numpy().view(np.uint64), np.diff(ends))
                held.append(np.stack([buckets, ids], axis=1))
                size += len(ids)
                if size >= PACK_ENTRIES:
                    yield pack(held)
                    held, size = [], 0
            if size:
                yield pack(held)

        return run

    def met(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packs = [x for batch in batches_ for x in batch.column("entries").to_pylist()]
        rows = np.frombuffer(b"".join(packs), dtype=np.uint64).reshape(-1, 2)
        del packs
        buckets, ids = rows[:, 0], rows[:, 1].view(np.int64)
        order = np.argsort(buckets)
        ranked = buckets[order]
        same = ranked[1:] == ranked[:-1]
        several = np.zeros(len(ranked), dtype=bool)
        several[1:] |= same
        several[:-1] |= same
        buckets, ids = ranked[several], ids[order[several]]
        order = np.lexsort((ids, buckets))
        buckets, ids = buckets[order], ids[order]
        first = np.ones(len(buckets), dtype=bool)
        first[1:] = buckets[1:] != buckets[:-1]
        new = first.copy()
        new[1:] |= ids[1:] != ids[:-1]
        buckets, ids, first = buckets[new], ids[new], first[new]
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(ids)))
        heads, n = np.repeat(ids[starts], sizes), np.repeat(sizes, sizes)
        shared = n > 1
        columns = [x[shared] for x in (buckets.view(np.int64), ids, heads, n)]
        found = pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["bucket", "id", "head", "n"])
        for at in range(0, len(found), OUT_ROWS):
            yield found.slice(at, OUT_ROWS)

    schema = "bucket bigint, id bigint, head bigint, n bigint"
    found = spark.createDataFrame([], schema)
    for round_ in range(PACK_ROUNDS if entries else 0):
        own = members.select("id", BUCKETS[round_])
        packs = own.mapInArrow(dealt(round_), "part int, entries binary").repartitionById(parts, F.col("part"))
        found = found.union(stored(packs.mapInArrow(met, schema), "shared-buckets"))
    return found


def shared_groups(
    shared: DataFrame,
    traits: DataFrame,
    near: Callable[[Column, Column], Column],
    verified: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``linked_groups`` of what ``shared_buckets`` found; ``traits`` has (id, trait)."""
    pairs = shared.where("id > head").select(F.col("id").alias("a"), F.col("head").alias("b")).distinct()
    own = [traits.select(F.col("id").alias(c), F.col("trait").alias(f"t{c}")) for c in "ab"]
    pairs = pairs.join(own[0], "a").join(own[1], "b").where(near(F.col("ta"), F.col("tb"))).select("a", "b")
    # Two members are compared by these pairs.
    return _groups_of_shared(shared.where("n > 2").drop("n"), pairs, near, verified, traits)


def _groups_of_shared(
    shared: DataFrame,
    pairs: DataFrame,
    near: Callable[[Column, Column], Column],
    verified: Callable[[DataFrame], DataFrame],
    traits: DataFrame | None = None,
) -> DataFrame:
    """Groups from ``pairs`` of members and heads, and from those that are then left in shared buckets."""
    links = stored(verified(stored(pairs, "pairs")), "links")
    groups = stored(components(links), "groups")
    labelled = shared.join(groups.select(F.col("node").alias("id"), "root"), "id", "left")
    labelled = labelled.withColumn("root", F.coalesce("root", "id"))
    mixed = labelled.groupBy("bucket").agg(
        F.min("root").alias("_low"), F.max("root").alias("_high"), F.count(F.lit(1)).alias("_n")
    )
    # Two members have been compared already.
    labelled = labelled.join(mixed.where("_low < _high and _n > 2").select("bucket"), "bucket")
    labelled = stored(labelled.join(traits, "id") if traits is not None else labelled, "open-buckets")
    left = labelled.where("id > head").select("bucket", F.col("id").alias("a"), F.col("trait").alias("ta"), F.col("root").alias("ra"))
    right = labelled.where("id > head").select("bucket", F.col("id").alias("b"), F.col("trait").alias("tb"), F.col("root").alias("rb"))
    together = (left["bucket"] == right["bucket"]) & (F.col("a") > F.col("b")) & (F.col("ra") != F.col("rb"))
    rest = left.join(right, together & near(F.col("ta"), F.col("tb"))).select("a", "b", "ra", "rb").distinct()
    rest = stored(rest, "more-pairs")
    if not rest.head(1):
        return groups
    # Only the roots that are linked anew are looked at again.
    more = stored(verified(rest.select("a", "b")), "links").join(rest, ["a", "b"])
    merged = stored(components(more.select(F.col("ra").alias("a"), F.col("rb").alias("b"))), "merged-groups")
    before = groups.union(merged.select("node", "node")).distinct()
    new = merged.select(F.col("node").alias("root"), F.col("root").alias("new_root"))
    return stored(before.join(new, "root", "left").select("node", F.coalesce("new_root", "root").alias("root")), "groups")
