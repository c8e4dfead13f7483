"""Near duplicates by Order MinHash, verified by banded alignment.

The k-mers of a text are its runs of two words, or single words in a short text,
each labelled with its occurrence number, so repeats count. A sketch takes the
least labelled k-mers under one hash function and keeps them in the order of the
text; texts with equal sketches share k-mers in the same order, which is likely
for a small edit distance. Every sketch puts its text into a bucket. Pairs in a bucket are
verified by the alignment of their words, within the band that a similarity of
0.8 allows: 1 - edits / words of the longer text.

Texts with equal word sequences are one text. Texts without words, empty ones and nulls, are no duplicates of
anything. A null id counts as the greatest. Repeated rows are copies: one of
them stays. Other columns are passed on; added ones replace columns of the same
name.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namelens.llm.linking import linked_groups
from namelens.llm.rows import keyed, packed, texts_of, unpacked
from namelens.llm.stored import stored
from namelens.llm.words import batches, mixed, range_hashes, window_hashes, words_of

KMER = 2
SKETCHES = 64
SKETCH_KMERS = 3
SIMILARITY = 0.8


class Scheme(NamedTuple):
    """How texts of ``least`` to ``most`` words are sketched."""

    least: int
    most: int
    k: int
    kmers: int
    count: int


# Every fifth word edited leaves pairs of words a similarity of 0.47 and single
# words one of 0.67, also in a text of few words. Texts of 0.8 edit similarity
# always have a scheme in common: each begins at 0.8 of the end of the one before.
SCHEMES = (
    Scheme(1, 12, 1, 3, 48),
    Scheme(9, 40, 1, 4, 48),
    Scheme(32, 1 << 62, KMER, SKETCH_KMERS, SKETCHES),
)

# Cells of the matrix of sketches and k-mers that are worked on at once.
MATRIX_CELLS = 1 << 20

_SEEDS = mixed(np.arange(1, 1025, dtype=np.uint64)) | np.uint64(1)


def labelled_kmers(words: np.ndarray, k: int = KMER) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-mers, and of the k-mers with their occurrence numbers."""
    size = min(k, len(words))
    plain = window_hashes(words, size) if size else words
    order = np.argsort(plain, kind="stable")
    ranked = plain[order]
    new = np.r_[True, ranked[1:] != ranked[:-1]]
    first = np.flatnonzero(new)
    number = np.arange(len(plain)) - np.repeat(first, np.diff(np.r_[first, len(plain)]))
    label = np.empty(len(plain), dtype=np.uint64)
    label[order] = mixed(ranked + mixed(number.astype(np.uint64) + np.uint64(1)))
    return plain, label


def sketches(words: np.ndarray, count: int = SKETCHES, kmers: int = SKETCH_KMERS, k: int = KMER) -> np.ndarray:
    """One hash for each sketch of a text with at least one word."""
    plain, label = labelled_kmers(words, k)
    kmers = min(kmers, len(plain))
    least = np.empty((count, kmers), dtype=np.int64)
    # All sketches of a usual text at once, few of a long one.
    step = max(1, MATRIX_CELLS // len(label))
    for i in range(0, count, step):
        # Multiplying by an odd number and folding the halves orders labels anew.
        value = label[None, :] * _SEEDS[i : min(i + step, count), None]
        value ^= value >> np.uint64(32)
        value *= _SEEDS[count + i : count + min(i + step, count), None]
        if kmers < len(label):
            least[i : i + step] = np.argpartition(value, kmers - 1, axis=1)[:, :kmers]
        else:
            least[i : i + step] = np.arange(kmers)
    least.sort(axis=1)
    starts = np.arange(count) * kmers
    return mixed(range_hashes(plain[least].ravel(), starts, starts + kmers) + np.arange(count, dtype=np.uint64))


def text_sketches(words: np.ndarray, schemes: tuple[Scheme, ...] = SCHEMES) -> np.ndarray:
    """The sketches of a text by all schemes for its length."""
    own = [(n, s) for n, s in enumerate(schemes) if s.least <= len(words) <= s.most]
    return np.concatenate([mixed(sketches(words, s.count, s.kmers, s.k) + np.uint64(n + 1)) for n, s in own])


def _labelled_rows(plain: np.ndarray) -> np.ndarray:
    """Hashes of the k-mers with their occurrence numbers; every row is a text."""
    order = np.argsort(plain, axis=1, kind="stable")
    ranked = np.take_along_axis(plain, order, axis=1)
    place = np.arange(plain.shape[1])
    new = np.ones(plain.shape, dtype=bool)
    new[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
    number = place - np.maximum.accumulate(np.where(new, place, 0), axis=1)
    label = np.empty_like(plain)
    np.put_along_axis(label, order, mixed(ranked + mixed(number.astype(np.uint64) + np.uint64(1))), axis=1)
    return label


def _sketch_rows(plain: np.ndarray, count: int, kmers: int) -> np.ndarray:
    """The sketches of texts with equally many k-mers, a row of ``plain`` each."""
    texts, size = plain.shape
    kmers = min(kmers, size)
    if kmers < size:
        # Multiplying by an odd number and folding the halves orders labels anew.
        value = _labelled_rows(plain)[:, None, :] * _SEEDS[:count, None]
        value ^= value >> np.uint64(32)
        value *= _SEEDS[count : 2 * count, None]
        # Sorting rows is vectorised, finding their least places is not.
        last = np.sort(value, axis=2)[:, :, kmers - 1 : kmers]
        least = np.flatnonzero(value <= last)
        if len(least) != texts * count * kmers:  # equal labels of different k-mers
            least = np.argpartition(value, kmers - 1, axis=2)[:, :, :kmers]
            least.sort(axis=2)
            least += np.arange(texts * count).reshape(texts, count, 1) * size
        at = least.reshape(texts, count, kmers)
        at = at % size + np.arange(texts)[:, None, None] * size
        chosen = plain.ravel()[at.reshape(-1, kmers)]
    else:
        chosen = np.repeat(plain, count, axis=0)
    starts = np.arange(texts * count) * kmers
    hashes = range_hashes(chosen.ravel(), starts, starts + kmers).reshape(texts, count)
    return mixed(hashes + np.arange(count, dtype=np.uint64))


def all_sketches(
    hashes: np.ndarray, first: np.ndarray, sizes: np.ndarray, schemes: tuple[Scheme, ...] = SCHEMES
) -> tuple[np.ndarray, np.ndarray]:
    """``text_sketches`` of many texts: text ``i`` has ``sizes[i]`` words from ``first[i]`` on.

    Returns the sketches and where those of each text begin, with the end of the last.
    Texts of equal length are worked on together, long ones alone. A text without
    words has no sketches.
    """
    held = [(sizes >= max(s.least, 1)) & (sizes <= s.most) for s in schemes]
    counts = sum((h * s.count for h, s in zip(held, schemes)), np.zeros(len(sizes), dtype=np.int64))
    ends = np.concatenate(([0], np.cumsum(counts)))
    out = np.empty(ends[-1], dtype=np.uint64)
    begins = ends[:-1].copy()
    order = np.argsort(sizes, kind="stable")
    ranked = sizes[order]
    edges = np.concatenate(([0], np.flatnonzero(np.diff(ranked)) + 1, [len(ranked)]))
    for n, s in enumerate(schemes):
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if a == b or not held[n][order[a]]:
                continue
            size = int(ranked[a])
            k = min(s.k, size)
            cells = (size - k + 1) * s.count
            step = max(1, MATRIX_CELLS // 4 // cells)
            for i in range(a, b, step):
                own = order[i : min(i + step, b)]
                if cells > MATRIX_CELLS:
                    rows = [sketches(hashes[first[t] : first[t] + size], s.count, s.kmers, s.k) for t in own]
                    found = np.stack(rows)
                else:
                    words = hashes[first[own][:, None] + np.arange(size)]
                    starts = (np.arange(len(own)) * size)[:, None] + np.arange(size - k + 1)
                    plain = range_hashes(words.ravel(), starts.ravel(), starts.ravel() + k).reshape(starts.shape)
                    found = _sketch_rows(plain, s.count, s.kmers)
                out[begins[own][:, None] + np.arange(s.count)] = mixed(found + np.uint64(n + 1))
        begins += held[n] * s.count
    return out, ends


def words_in_common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the multiset intersection: no alignment matches more words."""
    _, own = np.unique(np.concatenate([a, b]), return_inverse=True)
    size = int(own.max()) + 1 if len(own) else 0
    return int(np.minimum(np.bincount(own[: len(a)], minlength=size), np.bincount(own[len(a) :], minlength=size)).sum())


def one_gap_edits(a: np.ndarray, b: np.ndarray) -> int:
    """Edits of the best alignment in which the shorter text has its missing words at one place."""
    if len(a) > len(b):
        a, b = b, a
    n, gap = len(a), len(b) - len(a)
    before = a != b[:n]
    if not gap:
        return int(np.count_nonzero(before))
    after = a != b[gap:]
    # Left of the gap the words of the first alignment count, right of it those of the second.
    change = np.cumsum(before.astype(np.int64) - after)
    return gap + int(np.count_nonzero(after)) + min(0, int(change.min()) if n else 0)


def anchored_edits(a: np.ndarray, b: np.ndarray) -> int:
    """Edits of one good alignment: through runs of three words that each text has once."""
    grams = []
    for x in (a, b):
        values, first, counts = np.unique(window_hashes(x, 3), return_index=True, return_counts=True)
        grams.append((values[counts == 1], first[counts == 1]))
    _, i, j = np.intersect1d(grams[0][0], grams[1][0], assume_unique=True, return_indices=True)
    i, j = grams[0][1][i], grams[1][1][j]
    order = np.argsort(i)
    i, j = i[order], j[order]
    # The longest increasing run of places in b.
    tails, ends, before = [], [], []
    for k, place in enumerate(j.tolist()):
        at = bisect_left(tails, place)
        before.append(ends[at - 1] if at else -1)
        if at == len(tails):
            tails.append(place)
            ends.append(k)
        else:
            tails[at], ends[at] = place, k
    chain, k = [], ends[-1] if ends else -1
    while k >= 0:
        chain.append(k)
        k = before[k]
    i = np.concatenate([[-1], i[chain[::-1]], [len(a)]])
    j = np.concatenate([[-1], j[chain[::-1]], [len(b)]])
    di, dj = np.diff(i), np.diff(j)
    edits = 0
    for k in np.flatnonzero((di > 1) | (dj > 1)).tolist():
        x, y = a[i[k] + 1 : i[k + 1]], b[j[k] + 1 : j[k + 1]]
        if len(x) == len(y):
            edits += int((x != y).sum())
        else:
            # The words after an anchor match as far as they do; the rest is replaced.
            n = min(len(x), len(y))
            off = np.flatnonzero(x[:n] != y[:n])
            edits += max(len(x), len(y)) - (int(off[0]) if len(off) else n)
    return edits


def near_enough(a: np.ndarray, b: np.ndarray, most: int) -> bool:
    """Whether the edit distance is at most ``most``.

    Alignments with one gap, a bound from the words in common and one from a good
    alignment settle most pairs; the others are aligned in full.
    """
    longer = max(len(a), len(b))
    if abs(len(a) - len(b)) > most:
        return False
    if one_gap_edits(a, b) <= most:
        return True
    if longer - words_in_common(a, b) > most:
        return False
    if anchored_edits(a, b) <= most:
        return True
    return edit_distance(a, b, most) is not None


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """Edits between two sequences, or None if more than ``most``: banded alignment."""
    if abs(len(a) - len(b)) > most:
        return None
    n = min(len(a), len(b))
    differs = np.flatnonzero(a[:n] != b[:n])
    head = int(differs[0]) if len(differs) else n
    a, b, n = a[head:], b[head:], n - head
    if n:
        differs = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
        tail = int(differs[0]) if len(differs) else n
        a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not len(a) or not len(b):
        distance = max(len(a), len(b))
        return distance if distance <= most else None
    few = min(most, 24)
    found = _few_edits(a, b, few)
    if found is not None or few == most:
        return found
    # No alignment stays within a band that is narrower than the lengths differ.
    band = max(2 * few, abs(len(a) - len(b)))
    while True:
        found = _banded(a, b, min(band, most))
        if found is not None or band >= most:
            return found
        band *= 4


def _few_edits(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """How far each diagonal gets with 0, 1, 2, … edits; quick for few edits."""
    n, m = len(a), len(b)

    def slide(i: int, j: int) -> int:
        step = 32
        while i < n and j < m:
            size = min(step, n - i, m - j)
            off = a[i : i + size] != b[j : j + size]
            at = int(off.argmax())
            if off[at]:
                return i + at
            i, j, step = i + size, j + size, step * 4
        return i

    reach = {0: slide(0, 0)}
    if reach[0] >= n and n == m:
        return 0
    for edits in range(1, most + 1):
        new = {}
        for d in range(-edits, edits + 1):
            if not -n <= d <= m:
                continue
            i = max(reach.get(d, -2) + 1, reach.get(d - 1, -1), reach.get(d + 1, -2) + 1)
            i = min(i, n, m - d)
            if i < 0 or i + d < 0:
                continue
            new[d] = slide(i, i + d)
        reach = new
        if reach.get(m - n, -1) >= n:
            return edits
    return None


def _banded(a: np.ndarray, b: np.ndarray, band: int) -> int | None:
    """Row by row alignment with at most ``band`` off the diagonal."""
    n, m = len(a), len(b)
    far = n + m + 1
    width = 2 * band + 1
    offsets = np.arange(width)
    # Column j of row i is at j - i + band.
    row = np.where((offsets >= band) & (offsets - band <= m), offsets - band, far)
    padded = np.concatenate([np.zeros(band, dtype=b.dtype), b, np.zeros(width + n, dtype=b.dtype)])
    for i in range(1, n + 1):
        column = offsets + i - band
        same = padded[i - 1 : i - 1 + width] == a[i - 1]
        best = row + ~same
        best[:-1] = np.minimum(best[:-1], row[1:] + 1)
        best[(column < 0) | (column > m)] = far
        if i <= band:
            best[band - i] = i
        row = np.minimum.accumulate(best - offsets) + offsets
        row[(column < 0) | (column > m)] = far
        if row.min() > band:
            return None
    distance = int(row[m - n + band])
    return distance if distance <= band else None


def described(docs: DataFrame, schemes: tuple[Scheme, ...] = SCHEMES) -> DataFrame:
    """Per document with words: the id of its word sequence, its words and its sketches."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            rows = list(zip(*[batch.column(n).to_pylist() for n in ("_doc", "_key", "text")]))
            for part in batches(rows, lambda r: len(r[2])):
                words = words_of([r[2].encode() for r in part])
                out = [[], [], [], [], []]
                for i, (doc, key, _) in enumerate(part):
                    own = words.hashes[words.first[i] : words.first[i + 1]]
                    if len(own):
                        digest = hashlib.blake2b(own.tobytes(), digest_size=8).digest()
                        values = (doc, key, int.from_bytes(digest, "big", signed=True), len(own))
                        for held, value in zip(out, values):
                            held.append(value)
                        out[4].append(text_sketches(own, schemes).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.array(x, pa.int64()) for x in out[:4]],
                        pa.array(out[4], pa.list_(pa.int64())),
                    ],
                    ["_doc", "_key", "sequence", "n_words", "sketches"],
                )

    return texts_of(docs).mapInArrow(
        run, "_doc bigint, _key bigint, sequence bigint, n_words bigint, sketches array<bigint>"
    )


def most_edits(n: Column, similarity: float) -> Column:
    return F.floor(n * (1 - similarity) + 1e-9)


def near_groups(
    docs: DataFrame, similarity: float = SIMILARITY, schemes: tuple[Scheme, ...] = SCHEMES
) -> DataFrame:
    """Per document with words: (_doc, _key, sequence, group). Groups are linked word sequences."""
    rows = stored(described(docs, schemes), "sketches")
    texts = rows.groupBy("sequence").agg(
        F.first("n_words").alias("n_words"), F.min(F.struct("_doc", "_key")).alias("at"), F.first("sketches").alias("sketches")
    )
    texts = stored(texts, "sequences")
    members = texts.select(
        F.explode("sketches").alias("bucket"), F.col("sequence").alias("id"), F.col("n_words").alias("trait")
    )

    def near(x: Column, y: Column) -> Column:
        return F.abs(x - y) <= most_edits(F.greatest(x, y), similarity)

    def verified(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("sequence")).union(pairs.select("b")).distinct()
        at = wanted.join(texts, "sequence").select("sequence", "at.*")
        found = texts_of(docs).join(at, ["_doc", "_key"]).select("sequence", "text").dropDuplicates(["sequence"])
        found = stored(found, "sequence-texts")
        both = pairs.join(found.select(F.col("sequence").alias("a"), F.col("text").alias("ta")), "a").join(
            found.select(F.col("sequence").alias("b"), F.col("text").alias("tb")), "b"
        )

        def aligned(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in parts:
                rows = list(zip(*[batch.column(n).to_pylist() for n in ("a", "b", "ta", "tb")]))
                for part in batches(rows, lambda r: len(r[2]) + len(r[3])):
                    words = words_of([t.encode() for r in part for t in r[2:]])
                    own = [words.hashes[x:y] for x, y in zip(words.first, words.first[1:])]
                    kept = []
                    for (a, b, *_), x, y in zip(part, own[::2], own[1::2]):
                        most = int(np.floor(max(len(x), len(y)) * (1 - similarity) + 1e-9))
                        if near_enough(x, y, most):
                            kept.append((a, b))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k[i] for k in kept], pa.int64()) for i in (0, 1)], ["a", "b"]
                    )

        return both.mapInArrow(aligned, "a bigint, b bigint")

    groups = linked_groups(members, near, verified)
    named = rows.select("_doc", "_key", "sequence").join(groups.withColumnRenamed("node", "sequence"), "sequence", "left")
    return named.select("_doc", "_key", "sequence", F.coalesce("root", "sequence").alias("group"))


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents without those of a group but its first: the least id, then text hash.

    Only documents in groups of several rows are looked up; of equal rows one stays.
    """
    named = stored(near_groups(docs, similarity), "near-groups")
    at = F.struct("_doc", "_key")
    groups = named.groupBy("group").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    judged = named.join(groups, "group").select("_doc", "_key", (at == F.col("first")).alias("stays")).distinct()
    rows = keyed(packed(docs, ["doc_id", "text"])).join(judged, ["_doc", "_key"], "left")
    alone = rows.where("stays is null")
    first = rows.where("stays").dropDuplicates(["_doc", "_key"])
    return unpacked(alone.union(first), docs.columns)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every document, named by the least id in it, and its number of rows.

    ``n_texts`` counts the different word sequences of the group. Documents
    without words are groups of their own.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    named = stored(near_groups(docs), "near-groups")
    sizes = named.groupBy("group").agg(
        F.min("_doc").alias("group_id"), F.count(F.lit(1)).alias("n_docs"), F.count_distinct("sequence").alias("n_texts")
    )
    found = named.join(sizes, "group").select("_doc", "_key", "group_id", "n_docs", "n_texts").distinct()
    ids = keyed(docs).select("doc_id", "_doc", "_key")
    return ids.join(found, ["_doc", "_key"], "left").select(
        "doc_id",
        F.coalesce("group_id", "doc_id").alias("group_id"),
        F.coalesce("n_docs", F.lit(1)).alias("n_docs"),
        F.coalesce("n_texts", F.lit(1)).alias("n_texts"),
    )
