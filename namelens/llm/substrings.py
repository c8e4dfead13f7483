"""Substring deduplication by level-wise doubling.

A window of words that occurs in two texts has shorter windows that do. So
windows of a short length are looked up in the whole corpus first; only where
one is found in another text is the text looked at again at twice the length,
until the asked length is reached or no candidate is left. Below the asked
length a sample is enough: of all short windows inside a long one, the one with
the least hash. Equal long windows have equal least ones, so none is missed.

At the asked length every candidate window is compared: a window is removed
where its words also start earlier, in a document with a smaller id or further
up in the same one. Repeats inside one document need no lookup. Documents with
equal word sequences are matched as wholes first.

Null texts have no words. Texts shorter than a window lose nothing. A null id
counts as the greatest. Repeated rows (equal id and text) are one document and
get the same result each; rows with one id and different texts are not earlier
than each other. Other columns are passed on; added ones replace columns of the
same name. Window hashes have 64 bits below the asked length, where a collision
only costs time, and 128 bits at it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namelens.llm.rows import kept_columns, keyed, packed, row_field, texts_of, unpacked
from namelens.llm.stored import stored
from namelens.llm.words import Words, batches, window_hashes, words_of

WINDOW = 20
FIRST_LENGTH = 5


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[list[dict], Words]]:
    """The rows of a batch in parts, with the words of their texts."""
    names = batch.schema.names
    columns = [batch.column(n).to_pylist() for n in names]
    rows = [dict(zip(names, values)) for values in zip(*columns)]
    for part in batches(rows, lambda r: len(r["text"])):
        yield part, words_of([r["text"].encode() for r in part])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` consecutive ones."""
    out, held = values, 1
    while held < width:
        step = min(held, width - held)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        held += step
    return out


def _runs(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of equal values at consecutive starts: value, first start, last start."""
    if not len(values):
        return values, starts, starts
    new = np.flatnonzero(np.r_[True, (values[1:] != values[:-1]) | (starts[1:] != starts[:-1] + 1)])
    ends = np.r_[new[1:], len(values)] - 1
    return values[new], starts[new], starts[ends]


def _expanded(ranges: list | None, windows: int) -> np.ndarray:
    """Window starts of (first, last) ranges, or all of them."""
    if ranges is None:
        return np.arange(windows)
    mask = np.zeros(windows + 1, dtype=np.int64)
    pairs = np.array(ranges, dtype=np.int64).reshape(-1, 2)
    np.add.at(mask, pairs[:, 0], 1)
    np.add.at(mask, pairs[:, 1] + 1, -1)
    return np.flatnonzero(np.cumsum(mask)[:windows] > 0)


def whole_texts(docs: DataFrame) -> DataFrame:
    """Word count and a 128-bit hash of the word sequence of every document."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for rows, words in _rows(batch):
                sizes = np.diff(words.first)
                hashes = []
                for i in range(len(rows)):
                    own = words.hashes[words.first[i] : words.first[i + 1]]
                    digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                    hashes.append((int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["_doc"] for r in rows], pa.int64()),
                        pa.array([r["_key"] for r in rows], pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([h[0] for h in hashes], pa.int64()),
                        pa.array([h[1] for h in hashes], pa.int64()),
                    ],
                    ["_doc", "_key", "n_words", "h1", "h2"],
                )

    return texts_of(docs).mapInArrow(run, "_doc bigint, _key bigint, n_words bigint, h1 bigint, h2 bigint")


def anchors(texts: DataFrame, length: int, window: int) -> DataFrame:
    """For every candidate window the least hash of its sub-windows of ``length`` words.

    One row for each run of windows that share it. ``ranges``, where the texts
    have such a column, are the candidates. ``_seq`` names the word sequence of
    the whole text: equal texts do not count as each other's repeats.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for rows, words in _rows(batch):
                found = []
                for i, row in enumerate(rows):
                    own = words.hashes[words.first[i] : words.first[i + 1]]
                    if len(own) < window:
                        continue
                    least = _least(window_hashes(own, length), window - length + 1)
                    starts = _expanded(row.get("ranges"), len(least))
                    value, first, last = _runs(least[starts], starts)
                    sequence = int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "big", signed=True)
                    found.append((row["_doc"], row["_key"], sequence, value, first, last))
                sizes = [len(f[3]) for f in found]
                columns = [np.repeat(np.array([f[k] for f in found], dtype=np.int64), sizes) for k in range(3)]
                joined = [np.concatenate([f[k] for f in found] or [np.zeros(0)]) for k in (3, 4, 5)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(joined[0].astype(np.uint64).view(np.int64)),
                        *[pa.array(c) for c in columns],
                        pa.array(joined[1].astype(np.int32)),
                        pa.array(joined[2].astype(np.int32)),
                    ],
                    ["hash", "_doc", "_key", "_seq", "first", "last"],
                )

    return texts.mapInArrow(run, "hash bigint, _doc bigint, _key bigint, _seq bigint, first int, last int")


def survivors(rows: DataFrame) -> DataFrame:
    """Candidate ranges by document: anchors that stand in texts of two word sequences.

    The sequences of an anchor are reduced to the least and greatest before the
    shuffle, however frequent it is.
    """
    both = rows.groupBy("hash").agg(F.min("_seq").alias("a"), F.max("_seq").alias("b")).where("a < b").select("hash")
    left = rows.drop("_seq").join(both, "hash").select("_doc", "_key", F.struct("first", "last").alias("range"))
    return left.groupBy("_doc", "_key").agg(F.collect_list("range").alias("ranges"))


def _ranged(texts: DataFrame, ranges: DataFrame) -> DataFrame:
    pairs = F.transform("ranges", lambda r: F.array(r["first"], r["last"]))
    return texts.join(ranges.select("_doc", "_key", pairs.alias("ranges")), ["_doc", "_key"])


def windows(texts: DataFrame, window: int) -> DataFrame:
    """The first occurrence in its document of every candidate window.

    The hash has two parts, one for each half of the window.
    """
    half = window // 2

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for rows, words in _rows(batch):
                out = [[], [], [], [], []]
                for i, row in enumerate(rows):
                    own = words.hashes[words.first[i] : words.first[i + 1]]
                    starts = _expanded(row["ranges"], len(own) - window + 1)
                    left, right = window_hashes(own, half), window_hashes(own, window - half)
                    _, at = np.unique(window_hashes(own, window)[starts], return_index=True)
                    starts = starts[np.sort(at)]
                    out[0].append(left[starts])
                    out[1].append(right[starts + half])
                    out[2].append(np.full(len(starts), row["_doc"], dtype=np.int64))
                    out[3].append(np.full(len(starts), row["_key"], dtype=np.int64))
                    out[4].append(starts.astype(np.int32))
                joined = [np.concatenate(x) for x in out]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(joined[0].view(np.int64)),
                        pa.array(joined[1].view(np.int64)),
                        *[pa.array(x) for x in joined[2:]],
                    ],
                    ["h1", "h2", "_doc", "_key", "start"],
                )

    return texts.mapInArrow(run, "h1 bigint, h2 bigint, _doc bigint, _key bigint, start int")


def repeated_windows(docs: DataFrame, window: int = WINDOW, first_length: int = FIRST_LENGTH) -> DataFrame:
    """Per document the starts of windows whose words are in a document with a smaller id.

    Columns ``_doc``, ``_key``, ``starts`` and ``copy``: whether all words are those
    of a document with a smaller id.
    """
    whole = stored(whole_texts(docs), "whole-texts")
    least = whole.groupBy("h1", "h2").agg(F.min("_doc").alias("_least"))
    copies = whole.join(least, ["h1", "h2"]).where("_doc > _least").select("_doc", "_key").distinct()
    copies = stored(copies, "copies")
    texts = texts_of(docs)
    length, ranges = min(first_length, window), None
    while length < window:
        source = texts if ranges is None else _ranged(texts, ranges)
        found = stored(anchors(source, length, window), "anchors")
        found = survivors(found)
        if ranges is None:
            # Copies are removed as wholes.
            found = found.join(copies, ["_doc", "_key"], "left_anti")
        ranges = stored(found, "candidates")
        length *= 2
    if ranges is None:
        everything = F.array(F.struct(F.lit(0).alias("first"), (F.col("n_words") - window).cast("int").alias("last")))
        ranges = whole.where(F.col("n_words") >= window).select("_doc", "_key", everything.alias("ranges")).distinct()
    # Repeated rows give repeated windows, which change no minimum and no set.
    found = stored(windows(_ranged(texts, ranges), window), "windows")
    earliest = found.groupBy("h1", "h2").agg(F.min("_doc").alias("_least"), F.max("_doc").alias("_most"))
    earliest = earliest.where("_least < _most").select("h1", "h2", "_least")
    later = found.join(earliest, ["h1", "h2"]).where("_doc > _least")
    later = later.groupBy("_doc", "_key").agg(F.collect_set("start").alias("starts"))
    marks = later.join(copies.withColumn("copy", F.lit(True)), ["_doc", "_key"], "full_outer")
    return stored(marks.select("_doc", "_key", "starts", F.coalesce("copy", F.lit(False)).alias("copy")), "repeats")


def remove_repeats(docs: DataFrame, window: int = WINDOW, first_length: int = FIRST_LENGTH) -> DataFrame:
    """Add ``n_words``, ``n_removed``, ``kept_text`` and the removed ``spans`` (word places, end exclusive).

    ``kept_text`` has the words that are left, joined by single spaces.
    """
    marks = repeated_windows(docs, window, first_length)
    added = [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_text", T.StringType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
    ]
    names = [f.name for f in added]
    schema = T.StructType([row_field(docs, names), *added])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            starts, copies = batch.column("starts").to_pylist(), batch.column("copy").to_pylist()
            rows = list(zip(range(len(texts)), texts, starts, copies))
            for part in batches(rows, lambda r: len(r[1])):
                words = words_of([r[1].encode() for r in part])
                counts, removed, left, spans = [], [], [], []
                for i, (_, _, own_starts, copy) in enumerate(part):
                    own = words.hashes[words.first[i] : words.first[i + 1]]
                    gone = _removed(own, window, own_starts, bool(copy))
                    counts.append(len(own))
                    removed.append(int(gone.sum()))
                    edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                    spans.append(edges.reshape(-1, 2).tolist())
                    pieces = words.texts(i)
                    left.append(b" ".join([w for w, g in zip(pieces, gone.tolist()) if not g]).decode())
                out = batch.slice(part[0][0], len(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        out.column("_row"),
                        pa.array(counts, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(left, pa.string()),
                        pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                    ],
                    [f.name for f in schema.fields],
                )

    rows = keyed(packed(docs, ["doc_id", "text"], names)).join(marks, ["_doc", "_key"], "left")
    rows = rows.select("_row", "text", "starts", "copy").mapInArrow(run, schema)
    return unpacked(rows, kept_columns(docs, names), {n: F.col(n) for n in names})


def _removed(own: np.ndarray, window: int, starts: list | None, copy: bool) -> np.ndarray:
    """Which words are covered by a window that is also earlier."""
    gone = np.zeros(len(own), dtype=bool)
    if len(own) < window:
        return gone
    if copy:
        return ~gone
    hashes = window_hashes(own, window)
    _, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    # Found earlier in another document, or not its own first occurrence here.
    elsewhere = np.zeros(len(index), dtype=bool)
    if starts:
        elsewhere[inverse[np.array(starts)]] = True
    repeated = elsewhere[inverse] | (index[inverse] != np.arange(len(hashes)))
    cover = np.zeros(len(own) + 1, dtype=np.int64)
    at = np.flatnonzero(repeated)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    return np.cumsum(cover)[:-1] > 0


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, removed words and the hash of the kept words of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


def op3_sql() -> str:
    """The same from all windows of all documents."""
    return f"""
with texts as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words from documents
), places as (
  select doc_id, unnest(range(1, len(words) - {WINDOW - 2})) as place, words from texts where len(words) >= {WINDOW}
), windows as (
  select doc_id, place, md5(array_to_string(words[place:place + {WINDOW - 1}], ' ')) as hash from places
), repeated as (
  select doc_id, place, row_number() over (partition by hash order by doc_id, place) as nth from windows
), gone as (
  select distinct doc_id, unnest(range(place, place + {WINDOW})) as place from repeated where nth > 1
), pieces as (
  select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as place from texts
), kept as (
  select p.doc_id, count(g.place) as n_removed,
    coalesce(string_agg(case when g.place is null then word end, ' ' order by p.place), '') as text
  from pieces p left join gone g on g.doc_id = p.doc_id and g.place = p.place group by p.doc_id
)
select t.doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  sha256(coalesce(kept.text, '')) as kept_sha256
from texts t left join kept using (doc_id)"""
