"""Exact top-k search by BM25 over a sharded inverted index with block-max pruning.

Each shard holds the postings of some documents. Document frequencies, the
number of documents and their mean length are those of the whole corpus, so
scores of different shards compare, and the best of all shards' best are exact.

Within a shard, WAND's test is made for many queries and documents at once.
Terms that are rare in the shard are added up from their postings. For the
frequent ones every block of documents has the greatest impact of each term; the
sum over the terms of a query bounds what they can add. Blocks in which no query's
bound reaches the k-th best score known so far are left out. In the others the
frequent terms are summed by one matrix product in single precision, whose error
is bounded; a document is scored in full only if its sum may reach the k-th best
score. Nothing that could be among the best is skipped.

A query is the set of the words of a text. Documents without words and null
texts match nothing; queries without words have no results. Null ids are no
queries, and come last among equal scores. Scores are rounded to six places;
equal ones are ordered by id. Repeated rows are results of their own. An empty
table gives no results.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from namelens.llm.stored import stored
from namelens.llm.words import batches, words_of

K1, B = 1.2, 0.75
TOP = 10
# Words and documents of one shard, at most (a longer text is a shard of its own).
SHARD_WORDS = 2_000_000
SHARD_DOCS = 60_000
BLOCK_DOCS = 16
# Documents whose texts are Python objects at once.
PIECE_ROWS = 1_000
# A shard has so many frequent terms at most, and so many values of them in all documents.
DENSE_TERMS = 768
DENSE_CELLS = 1 << 21
# Queries are sent to the shards in blocks of about so many terms.
BLOCK_TERMS = 2_000_000
QUERIES_AT_ONCE = 64
PLACES = 6
LAST_ID = (1 << 63) - 1
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _bags(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct word hashes of each text and their counts."""
    for part in batches(texts, len):
        words = words_of(part)
        for a, b in zip(words.first, words.first[1:]):
            yield np.unique(words.hashes[a:b], return_counts=True)


INDEX = "ids array<bigint>, lengths binary, terms binary, counts binary, docs binary, tfs binary"


def build_index(docs: DataFrame) -> DataFrame:
    """One row per shard: ids and lengths of its documents, terms, and their postings.

    A shard is made of neighbouring rows of a partition, so nothing is shuffled.
    """

    def shard(held: list) -> pa.RecordBatch:
        ids = [h[0] for h in held]
        sizes = np.array([len(h[1]) for h in held])
        lengths = np.array([h[2].sum() for h in held], dtype=np.int64)
        terms = np.concatenate([h[1] for h in held])
        tfs = np.concatenate([h[2] for h in held]).astype(np.int32)
        own = np.repeat(np.arange(len(held)), sizes).astype(np.uint16)
        order = np.argsort(terms, kind="stable")
        names, counts = np.unique(terms[order], return_counts=True)
        data = [lengths, names, counts.astype(np.int32), own[order], tfs[order]]
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(pa.int64())), *[pa.array([x.tobytes()], pa.binary()) for x in data]],
            ["ids", "lengths", "terms", "counts", "docs", "tfs"],
        )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words = [], 0
        for batch in (b.slice(at, PIECE_ROWS) for b in parts for at in range(0, b.num_rows, PIECE_ROWS)):
            ids = batch.column("doc_id").to_pylist()
            texts = ((t.as_py() or "").encode() for t in batch.column("text"))
            for doc_id, (terms, tfs) in zip(ids, _bags(list(texts))):
                if held and (words + int(tfs.sum()) > SHARD_WORDS or len(held) >= SHARD_DOCS):
                    yield shard(held)
                    held, words = [], 0
                if len(terms):
                    held.append((doc_id, terms, tfs))
                    words += int(tfs.sum())
        if held:
            yield shard(held)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, INDEX)


def document_frequencies(index: DataFrame) -> DataFrame:
    """Number of documents with each term, summed over the shards: (term, df)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for terms, counts in zip(batch.column("terms"), batch.column("counts")):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(terms.as_py(), dtype=np.int64)),
                        pa.array(np.frombuffer(counts.as_py(), dtype=np.int32).astype(np.int64)),
                    ],
                    ["term", "df"],
                )

    rows = index.select("terms", "counts").mapInArrow(run, "term bigint, df bigint")
    return rows.groupBy("term").agg(F.sum("df").alias("df"))


def weighted_queries(queries: DataFrame, frequencies: DataFrame, documents: int) -> DataFrame:
    """Terms of each query with their idf: (query_id, text_key, terms, weights)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            bags = _bags([(t.as_py() or "").encode() for t in batch.column("text")])
            terms = [t.view(np.int64) for t, _ in bags]
            sizes = [len(t) for t in terms]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column(c).to_numpy(zero_copy_only=False), sizes))
                    for c in ("query_id", "text_key")
                ]
                + [pa.array(np.concatenate([*terms, np.zeros(0, dtype=np.int64)]))],
                ["query_id", "text_key", "term"],
            )

    rows = queries.select("query_id", F.xxhash64("text").alias("text_key"), "text").distinct()
    rows = rows.mapInArrow(run, "query_id bigint, text_key bigint, term bigint")
    idf = F.log(1 + (documents - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return (
        rows.join(frequencies, "term")
        .groupBy("query_id", "text_key")
        .agg(F.array_sort(F.collect_list(F.struct("term", idf.alias("weight")))).alias("list"))
        .select("query_id", "text_key", F.col("list.term").alias("terms"), F.col("list.weight").alias("weights"))
    )


class Shard:
    """One row of the index, ready for queries whose terms are all in ``vocabulary``."""

    def __init__(self, row: dict, mean_length: float, vocabulary: np.ndarray):
        self.ids = np.array([LAST_ID if i is None else i for i in row["ids"]], dtype=np.int64)
        self.null = np.array([i is None for i in row["ids"]])
        lengths = np.frombuffer(row["lengths"], dtype=np.int64)
        terms = np.frombuffer(row["terms"], dtype=np.int64).view(np.uint64)
        counts = np.frombuffer(row["counts"], dtype=np.int32)
        docs = np.frombuffer(row["docs"], dtype=np.uint16)
        tfs = np.frombuffer(row["tfs"], dtype=np.int32)
        self.size = len(self.ids)
        self.blocks = -(-self.size // BLOCK_DOCS)
        impacts = tfs * (K1 + 1) / (tfs + (K1 * (1 - B + B * lengths / mean_length))[docs])
        ends = np.cumsum(counts)
        # The place of each term of the vocabulary, or -1.
        at = np.minimum(np.searchsorted(terms, vocabulary), len(terms) - 1)
        self.place = np.where(terms[at] == vocabulary, at, -1)
        # The most frequent terms have a value for each document, the others their postings.
        number = max(1, min(DENSE_TERMS, DENSE_CELLS // self.size, len(counts)))
        often = np.zeros(len(counts), dtype=bool)
        often[np.argpartition(counts, len(counts) - number)[len(counts) - number :]] = True
        self.dense_row = np.where(often, np.cumsum(often) - 1, -1)
        # A row for each document, so that the few that are scored in full are read in one piece.
        self.dense = np.zeros((self.blocks * BLOCK_DOCS, number))
        in_dense = np.repeat(often, counts)
        self.dense[docs[in_dense], np.repeat(self.dense_row, counts)[in_dense]] = impacts[in_dense]
        self.columns = np.ascontiguousarray(self.dense.T, dtype=np.float32)
        self.bounds = np.ascontiguousarray(self.columns.reshape(number, self.blocks, BLOCK_DOCS).max(axis=2))
        # A sum of that many products of values in single precision is off by this share of itself at most.
        self.error = (number + 8) * 2.0**-23
        self.docs, self.impacts, self.starts, self.counts = docs, impacts, ends - counts, counts

    def best(
        self, queries: list[tuple[np.ndarray, np.ndarray]], top: int, least: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Owners, places and rounded scores of the best documents of each query that share a term with it.

        Queries are numbers of terms in the vocabulary and their weights. Documents
        with a score below ``least`` of the query may be left out.
        """
        number = len(queries)
        owner = np.repeat(np.arange(number), [len(t) for t, _ in queries])
        at = self.place[np.concatenate([t for t, _ in queries])]
        weights = np.concatenate([w for _, w in queries])
        known = at >= 0
        owner, weights, at = owner[known], weights[known], at[known]
        rows = self.dense_row[at]
        frequent = rows >= 0
        dense_weights = np.zeros((number, self.dense.shape[1]))
        dense_weights[owner[frequent], rows[frequent]] = weights[frequent]
        # The exact part of the rare terms, for every query and document.
        rare = ~frequent
        counts = self.counts[at[rare]]
        ends = np.cumsum(counts)
        postings = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[at[rare]] - (ends - counts), counts)
        width = self.blocks * BLOCK_DOCS
        cell = np.repeat(owner[rare] * width, counts) + self.docs[postings]
        part = np.bincount(cell, weights=np.repeat(weights[rare], counts) * self.impacts[postings], minlength=number * width)
        part = part.astype(np.float64, copy=False).reshape(number, width)
        slack = 10.0**-PLACES
        # Blocks that no query's bound lets in are not looked at.
        single = dense_weights.astype(np.float32)
        bound = part.reshape(number, self.blocks, BLOCK_DOCS).max(axis=2) + single @ self.bounds
        lets_in = bound * (1 + self.error) >= (least - slack)[:, None]
        live = np.flatnonzero((lets_in & (bound > 0)).any(axis=0))
        if not len(live):
            nothing = np.zeros(0, dtype=np.int64)
            return nothing, nothing, np.zeros(0)
        if len(live) == self.blocks:
            places, near = np.arange(width), part + single @ self.columns
        else:
            places = (live[:, None] * BLOCK_DOCS + np.arange(BLOCK_DOCS)).ravel()
            near = part[:, places] + single @ self.columns[:, places]
        # The k-th best score is not below this, and no better document's estimate is.
        off = self.error * near.max(axis=1)
        limit = least - off
        if top < len(places):
            limit = np.maximum(limit, np.partition(near, len(places) - top, axis=1)[:, len(places) - top] - 2 * off)
        owner, found = np.nonzero((near >= (limit - slack)[:, None]) & (near > 0))
        places = places[found]
        scores = part[owner, places]
        step = max(1, DENSE_CELLS // self.dense.shape[1])
        for i in range(0, len(owner), step):
            own = slice(i, i + step)
            scores[own] += np.einsum("ij,ij->i", self.dense[places[own]], dense_weights[owner[own]])
        scores = np.round(scores, PLACES)
        order = np.lexsort((self.ids[places], -scores, owner))
        owner, places, scores = owner[order], places[order], scores[order]
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
        kept = (rank < top) & (scores > 0)
        return owner[kept], places[kept], scores[kept]


@contextmanager
def _single_rows(spark: SparkSession) -> Iterator[None]:
    """Send rows to Python one by one: a shard is large, and a task has several."""
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, "1")
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


def search(index: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` best documents of every query: query_id, rank, doc_id, score.

    ``queries`` has query_id and text. They go to the shards in blocks of a bounded
    number of terms; each block is one pass over the index.
    """
    spark = index.sparkSession

    def totals(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            sums = [int(np.frombuffer(x.as_py(), dtype=np.int64).sum()) for x in batch.column("lengths")]
            sizes = [len(x.as_py()) // 8 for x in batch.column("lengths")]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())], ["docs", "words"])

    documents, words = (
        index.select("lengths").mapInArrow(totals, "docs bigint, words bigint").agg(F.sum("docs"), F.sum("words")).first()
    )
    found = "query_id bigint, text_key bigint, doc_id bigint, score double"
    if not documents:
        return spark.createDataFrame([], "query_id bigint, rank int, doc_id bigint, score double")
    weighted = stored(weighted_queries(queries, document_frequencies(index), documents), "queries")
    mean = words / documents
    terms = weighted.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-terms // BLOCK_TERMS))
    parts = []
    for block in range(blocks):
        rows = weighted.where(F.pmod(F.xxhash64("query_id", "text_key"), F.lit(blocks)) == block).toArrow()
        sent = spark.sparkContext.broadcast(_packed(rows))

        def run(batches_: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, keys, vocabulary, own = _unpacked(sent.value)
            # The best scores of each query that this task has met.
            known = np.zeros((len(own), top))
            shard = None
            for batch in batches_:
                for row in range(batch.num_rows):
                    del shard  # before the next one is made
                    shard = Shard(batch.slice(row, 1).to_pylist()[0], mean, vocabulary)
                    for at in range(0, len(own), QUERIES_AT_ONCE):
                        now = slice(at, at + QUERIES_AT_ONCE)
                        names, places, scores = shard.best(own[now], top, known[now].min(axis=1))
                        new = np.zeros_like(known[now])
                        new[names, np.arange(len(names)) - np.searchsorted(names, names)] = scores
                        known[now] = np.sort(np.concatenate([known[now], new], axis=1), axis=1)[:, top:]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(ids[at + names]),
                                pa.array(keys[at + names]),
                                pa.array(shard.ids[places], mask=shard.null[places]),
                                pa.array(scores),
                            ],
                            ["query_id", "text_key", "doc_id", "score"],
                        )

        if len(rows):
            with _single_rows(spark):
                parts.append(stored(index.mapInArrow(run, found), "shard-results"))
        sent.unpersist()
    merged = spark.createDataFrame([], found)
    for part in parts:
        merged = merged.union(part)
    order = Window.partitionBy("query_id", "text_key").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.select("query_id", "rank", "doc_id", "score")


def _packed(rows: pa.Table) -> dict:
    """Queries as a few arrays; each term is named by its number among their different ones."""
    terms, weights = rows["terms"].combine_chunks(), rows["weights"].combine_chunks()
    sizes = np.array([len(x) for x in terms], dtype=np.int64)
    vocabulary, numbers = np.unique(terms.flatten().to_numpy().view(np.uint64), return_inverse=True)
    return {
        "ids": rows["query_id"].to_numpy(),
        "keys": rows["text_key"].to_numpy(),
        "sizes": sizes,
        "vocabulary": vocabulary,
        "terms": numbers.astype(np.int32),
        "weights": weights.flatten().to_numpy(),
    }


def _unpacked(packed: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    ends = np.cumsum(packed["sizes"])
    own = [
        (packed["terms"][a:b], packed["weights"][a:b]) for a, b in zip((ends - packed["sizes"]).tolist(), ends.tolist())
    ]
    return packed["ids"], packed["keys"], packed["vocabulary"], own


def op2_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every document whose id is divisible by 20."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    queries = docs.where(F.col("doc_id") % 20 == 0).select(F.col("doc_id").cast("bigint").alias("query_id"), "text")
    return search(stored(build_index(docs), "index"), queries)


def op2_sql() -> str:
    """The same results from a join of all query terms with all postings."""
    return f"""
with words as (
  select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as term from documents
), bags as (select doc_id, term, count(*) as tf from words group by all),
lengths as (select doc_id, count(*) as words from words group by doc_id),
corpus as (select count(*) as n, sum(words) / count(*) as mean from lengths),
terms as (select term, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) as idf from bags, corpus group by term, n),
scores as (
  select q.doc_id as query_id, d.doc_id,
    round(sum(idf * d.tf * {K1 + 1} / (d.tf + {K1} * ({1 - B} + {B} * words / mean))), {PLACES}) as score
  from bags q join terms using (term) join bags d using (term) join lengths on lengths.doc_id = d.doc_id, corpus
  where q.doc_id % 20 = 0
  group by q.doc_id, d.doc_id
), ranked as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, doc_id) as int) as rank, doc_id, score
  from scores where score > 0
)
select * from ranked where rank <= {TOP}"""
