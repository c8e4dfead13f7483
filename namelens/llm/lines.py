"""Line deduplication: fuzzy lines by Order MinHash, verified by edit similarity.

A line is normalised: lower case, no ASCII characters but letters, digits and the
points, commas and minus signs of numbers, words parted by single spaces. Lines
that differ in their numbers are different lines.
Lines whose words are equal are one line. The others are sketched as documents
are in ``near_duplicates``, by fewer sketches. Pairs with a sketch in common are
verified by the edit similarity of the normalised lines: 1 - edited words / words
of the longer one. Of each connected group of lines the first occurrence stays, by id
and place; all others go.

Lines without letters are never removed. Null texts count as empty and come
back as they are. A null id counts as the greatest. Repeated rows (equal id and
text) are one document and get the same result each; of rows with one id and
different texts, the one with the smaller text hash comes first. Other columns
are passed on; added ones replace columns of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namelens.llm.linking import BUCKETS, bucket_columns, shared_buckets, shared_groups
from namelens.llm.near_duplicates import Scheme, all_sketches, most_edits, near_enough
from namelens.llm.rows import kept_columns, keyed, packed, row_field, unpacked
from namelens.llm.stored import stored, stored_within
from namelens.llm.words import batches, range_hashes, words_of

SIMILARITY = 0.8
# Lines are many and short, so each has fewer sketches than a document.
SCHEMES = (Scheme(1, 12, 1, 3, 24), Scheme(9, 40, 1, 5, 32), Scheme(32, 1 << 62, 2, 3, 32))

# A task remembers so many lines that it has sketched.
SEEN_LINES = 1 << 17
# Lines of about so many words are sketched at once.
HELD_WORDS = 1 << 19
PIECE_ROWS = 1_000
# Columns of 64 bits each that tell most unlike lines apart.
MARKS = ("m0", "m1", "m2", "m3")

# Bytes after normalisation: letters, digits, line ends and all of other alphabets stay.
# Bytes that UTF-8 never has stand for the characters within numbers.
_NUMBERS = {b".": b"\xff", b",": b"\xfe", b"-": b"\xfd"}
_KEPT = {mark[0]: sign[0] for sign, mark in _NUMBERS.items()}
_LETTERS = bytes(
    _KEPT.get(b, b if (b < 0x80 and chr(b).isalnum()) or b >= 0x80 or b == 0x0A else 0x20) for b in range(256)
)
# It begins with the sign itself, which is found much faster than what stands before it.
_IN_NUMBER = re.compile(rb"[.,-](?=[0-9])(?:(?<=[0-9][.,])|(?<=-)(?<![0-9a-z\x80-\xff]-))")
_NO_LETTERS = b" 0123456789.,-"


def normalised(text: str) -> list[bytes]:
    """The normalised lines of a text in UTF-8; a line without letters is empty."""
    data = _IN_NUMBER.sub(lambda m: _NUMBERS[m[0]], text.lower().encode()).translate(_LETTERS)
    lines = [b" ".join(line.split()) for line in data.split(b"\n")]
    return [line if line.translate(None, _NO_LETTERS) else b"" for line in lines]


def pieces(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, so that their texts take little memory as Python objects."""
    for batch in parts:
        for at in range(0, batch.num_rows, PIECE_ROWS):
            yield batch.slice(at, PIECE_ROWS)


def lines_of(docs: DataFrame, schemes: tuple[Scheme, ...] = SCHEMES) -> DataFrame:
    """One row for each line with letters: document, place, hash of its words, and its sketches as buckets.

    A line that the task has lately met is not ``new`` and has no sketches.
    """
    names = ["_doc", "_key", "place", "line", "new", *BUCKETS]

    def sketched(held: list[tuple]) -> pa.RecordBatch:
        docs_, keys, places, ids, hashes, sizes, new = [np.concatenate(x) for x in zip(*held)]
        own = np.where(new, sizes, 0)
        found, ends = all_sketches(hashes, np.cumsum(sizes) - sizes, own, schemes)
        columns = [pa.array(x) for x in (docs_, keys, places, ids, new)]
        return pa.RecordBatch.from_arrays([*columns, *bucket_columns(found, ends)], names)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, size = [], 0
        for batch in pieces(parts):
            rows = list(zip(*[batch.column(n).to_pylist() for n in ("_doc", "_key", "text")]))
            for part in batches(rows, lambda r: len(r[2])):
                docs_, keys, places, lines = [], [], [], []
                for doc, key, text in part:
                    for place, line in enumerate(normalised(text)):
                        if line:
                            docs_.append(doc)
                            keys.append(key)
                            places.append(place)
                            lines.append(line)
                if not lines:
                    continue
                words = words_of(lines)
                ids = range_hashes(words.hashes, words.first[:-1], words.first[1:]).view(np.int64)
                new = []
                for line in ids.tolist():
                    new.append(line not in seen)
                    seen.add(line)
                if len(seen) > SEEN_LINES:
                    seen.clear()
                places_ = np.array(places, dtype=np.int32)
                held.append((np.array(docs_), np.array(keys), places_, ids, words.hashes, np.diff(words.first), np.array(new)))
                size += len(words.hashes)
                if size >= HELD_WORDS:
                    yield sketched(held)
                    held, size = [], 0
        if held:
            yield sketched(held)

    texts = keyed(docs.select("doc_id", "text")).where("text is not null").select("_doc", "_key", "text")
    buckets = ", ".join(f"{b} binary" for b in BUCKETS)
    return texts.mapInArrow(run, f"_doc bigint, _key bigint, place int, line bigint, new boolean, {buckets}")


def fuzzy_groups(occurrences: DataFrame, shared: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """Groups of different lines in shared buckets that are linked, as (node, root)."""
    met = shared.select(F.col("id").alias("line")).distinct()
    at = occurrences.where("new").join(met, "line").groupBy("line").agg(F.min(F.struct("_doc", "_key", "place")).alias("at"))
    lines = stored(lines_at(docs, at.select("line", "at.*")), "lines")

    def verified(pairs: DataFrame) -> DataFrame:
        own = [lines.select(F.col("line").alias(c), F.col("words").alias(f"w{c}")) for c in "ab"]
        rows = pairs.join(own[0], "a").join(own[1], "b")

        def aligned(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(parts):
                kept = []
                for a, b, wa, wb in zip(*[batch.column(n).to_pylist() for n in ("a", "b", "wa", "wb")]):
                    x, y = np.frombuffer(wa, dtype=np.uint64), np.frombuffer(wb, dtype=np.uint64)
                    if near_enough(x, y, int(max(len(x), len(y)) * (1 - similarity) + 1e-9)):
                        kept.append((a, b))
                yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in kept], pa.int64()) for i in (0, 1)], ["a", "b"])

        return rows.mapInArrow(aligned, "a bigint, b bigint")

    def near(x: Column, y: Column) -> Column:
        nx, ny = x["n_words"], y["n_words"]
        differ = reduce(add, [F.bit_count(x[m].bitwiseXOR(y[m])) for m in MARKS])
        most = most_edits(F.greatest(nx, ny), similarity)
        # An edit unmatches two words, or one if it makes a line longer or shorter.
        return (F.abs(nx - ny) <= most) & (differ <= 2 * most - F.abs(nx - ny))

    traits = lines.select(F.col("line").alias("id"), F.struct("n_words", *MARKS).alias("trait"))
    return shared_groups(shared, traits, near, verified)


def parities(words: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """For each text, the bits that an odd number of its words has; every text has words.

    Bits in which two texts differ are at most as many as words of one text that the other has not.
    """
    bit = np.uint64(1) << (words >> np.uint64(58))
    which = (words >> np.uint64(50)) % np.uint64(len(MARKS))
    own = [np.where(which == k, bit, np.uint64(0)) for k in range(len(MARKS))]
    return [np.bitwise_xor.reduceat(x, starts) if len(starts) else x[:0] for x in own]


def lines_at(docs: DataFrame, at: DataFrame) -> DataFrame:
    """The lines at (_doc, _key, place), as (line, n_words, marks, words); words are hashes as bytes."""
    wanted = at.groupBy("_doc", "_key").agg(F.collect_list(F.struct("place", "line")).alias("wanted"))
    texts = keyed(docs.select("doc_id", "text")).select("_doc", "_key", "text").join(wanted, ["_doc", "_key"])
    texts = texts.dropDuplicates(["_doc", "_key"]).select("text", "wanted.place", "wanted.line")
    names = ["line", "n_words", *MARKS, "words"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(parts):
            rows = list(zip(*[batch.column(n).to_pylist() for n in ("text", "place", "line")]))
            for part in batches(rows, lambda r: len(r[0])):
                ids, found = [], []
                for text, places, lines in part:
                    ids += lines
                    # A line is normalised as it is within its text.
                    text = text.split("\n")
                    found += normalised("\n".join([text[p] for p in places]))
                words = words_of(found)
                sizes = np.diff(words.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(sizes),
                        *[pa.array(x.view(np.int64)) for x in parities(words.hashes, words.first[:-1])],
                        pa.array([words.hashes[a:b].tobytes() for a, b in zip(words.first, words.first[1:])], pa.binary()),
                    ],
                    names,
                )

    marks = ", ".join(f"{m} bigint" for m in MARKS)
    return texts.mapInArrow(run, f"line bigint, n_words bigint, {marks}, words binary")


def repeated_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Per document the places of the lines to remove: (_doc, _key, places)."""
    # Repeated rows give repeated places, which change neither minima nor sets.
    # The sketches take more room than the texts and go as soon as buckets are found.
    with stored_within(lines_of(docs), "line-sketches") as found:
        occurrences = stored(found.select("_doc", "_key", "place", "line", "new"), "line-places")
        shared = shared_buckets(found.where("new").withColumnRenamed("line", "id"))
    groups = fuzzy_groups(occurrences, shared, docs, similarity)
    named = occurrences.join(groups.withColumnRenamed("node", "line"), "line", "left").select(
        "_doc", "_key", "place", F.coalesce("root", "line").alias("group")
    )
    named = stored(named, "line-groups")
    at = F.struct("_doc", "_key", "place")
    first = named.groupBy("group").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = named.join(first, "group").where(at != F.col("first"))
    return stored(later.groupBy("_doc", "_key").agg(F.collect_set("place").alias("places")), "removed-lines")


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Add ``n_lines``, ``n_removed`` and ``kept_text`` (null for a null text)."""
    removed = repeated_lines(docs, similarity)
    added = [
        T.StructField("n_lines", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_text", T.StringType()),
    ]
    names = [f.name for f in added]
    schema = T.StructType([row_field(docs, names), *added])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(parts):
            counts, gone, left = [], [], []
            texts = batch.column("_row").field(text_name)
            for text, places in zip(texts, batch.column("places").to_pylist()):
                text, out = text.as_py(), set(places or ())
                lines = text.split("\n") if text is not None else []
                counts.append(len(lines))
                gone.append(len(out))
                if out:
                    text = "\n".join([line for k, line in enumerate(lines) if k not in out])
                left.append(text)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row"),
                    pa.array(counts, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array(left, pa.string()),
                ],
                [f.name for f in schema.fields],
            )

    # The text travels once, within the row.
    text_name = next(c for c in docs.columns if c.lower() == "text")
    rows = keyed(packed(docs, ["doc_id", "text"], names)).drop("doc_id", "text")
    rows = rows.join(removed, ["_doc", "_key"], "left").select("_row", "places").mapInArrow(run, schema)
    return unpacked(rows, kept_columns(docs, names), {n: F.col(n) for n in names})


def op1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, removed lines and the hash of the kept text of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )
