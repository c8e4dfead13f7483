"""Toxicity from class-conditional Kneser-Ney models.

Two models of the characters of words, one learned from toxic and one from
ordinary documents, predict each character from those before it in its word.
Class counts are discounted, and what is really taken off goes to the lower
orders, which both classes share: interpolated Kneser-Ney models of
continuation counts from all documents, down to equal shares of all characters.
So the probabilities of each history sum to one, and an expression that is rare
in the labels counts about alike for both classes. The counts of the larger
class are scaled to the total of the smaller one, or an expression of neither
would speak for the class with fewer documents.

The log-likelihood ratio of a word is the sum over its characters. A document is
described by length-normalised ratios: the mean over its words, whole and
clipped, and the share and excess of words that are much likelier toxic. A
logistic regression on labelled documents that were not counted turns these
into a score.

Labels are learned from at most ``FIT_ROWS`` documents of each class, chosen by
a hash, and half as many as long as these have over ``MODEL_ENTRIES`` n-grams;
everything else covers all documents, and no n-gram of a chosen document is
left out. Null and empty texts have no words and get the score of a ratio of
zero; a long text is scored whole, in memory that grows with it alone. Rows are
scored one by one, so repeated rows get equal scores. No documents give no
rows. Labels other than 0 and 1, and documents with both, are not learned from.
Without documents of both classes all scores are the share of toxic labels, or
0. Added columns replace columns of the same name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namelens.llm.words import batches, mixed, no_cycles, range_hashes
from namelens.operators.snapshot import snapshot

# Characters of a history and the predicted one.
ORDER = 5
DISCOUNT = 2.0
# Taken off continuation counts.
SHARED_DISCOUNT = 0.75
# Labelled documents learned from, for each class.
FIT_ROWS = 20_000
# N-grams that the chosen documents may have, so that the model can be broadcast.
MODEL_ENTRIES = 4_000_000
# Words that a Python worker holds at once.
MEMORY_WORDS = 200_000
# Characters of words whose n-grams are counted at once.
GRAM_BYTES = 2 << 20
# A word with a ratio beyond this is much likelier toxic.
STRONG = 2.5
# Numbers that describe a document.
FEATURES = 5

BEGIN, END = "\x02", "\x03"

GRAMS = "gram string, n_all bigint, n_toxic bigint, n_ordinary bigint"


def fold(doc_id: Column) -> Column:
    """0 to 4 by the id; a null id counts as an empty one."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5))


class Grams:
    """The n-grams of words, one ending at each character: ``text[start:end]`` of the word ``owner``."""

    def __init__(self, words: list[str], order: int):
        self.text = "".join([BEGIN + w + END for w in words])
        self.values = code_points(self.text)
        lengths = np.array([len(w) + 2 for w in words], dtype=np.int64)
        first = np.repeat(np.cumsum(lengths) - lengths, lengths)
        place = np.arange(len(self.values))
        predicted = place > first
        self.end = place[predicted] + 1
        self.start = np.maximum(first[predicted], self.end - order)
        self.owner = np.repeat(np.arange(len(words)), lengths - 1)

    def hashes(self) -> np.ndarray:
        return range_hashes(self.values, self.start, self.end)


def fit_sample(labels: DataFrame, rows: int = FIT_ROWS, seed: int = 5) -> DataFrame:
    """At most ``rows`` training documents of each class: doc_id, toxic, weight.

    ``weight`` is the number of labelled documents that a chosen one stands for.
    """
    one = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_other"))
        .where("toxic = _other")
        .select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    )
    one = snapshot(one, "labels")
    parts = []
    for label in (0, 1):
        own = one.where(F.col("toxic") == label)
        n = own.count()
        by_hash = own.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(rows)
        parts.append(by_hash.withColumn("weight", F.lit(n / max(1, min(n, rows)))))
    return snapshot(parts[0].union(parts[1]), "fit-sample")


def count_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Counts of every character n-gram: in all texts, and in those of each ``_class``."""

    def flushed(words: list[Counter]) -> Iterator[pa.RecordBatch]:
        for part in batches(list(words[0]), len, GRAM_BYTES):
            grams = Grams(part, order)
            _, at, which = np.unique(grams.hashes(), return_index=True, return_inverse=True)
            columns = [pa.array([grams.text[a:b] for a, b in zip(grams.start[at].tolist(), grams.end[at].tolist())], pa.string())]
            for counts in words:
                own = np.array([counts[w] for w in part], dtype=np.float64)
                # Whole numbers below 2**53 are exact.
                columns.append(pa.array(np.bincount(which, own[grams.owner], len(at)).astype(np.int64)))
            yield pa.RecordBatch.from_arrays(columns, ["gram", "n_all", "n_toxic", "n_ordinary"])
        for counts in words:
            counts.clear()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = [Counter(), Counter(), Counter()]
        for batch in parts:
            texts, classes = batch.column(0), batch.column(1).to_pylist()
            for text, label in zip(texts, classes):
                own = (text.as_py() or "").lower().split()
                words[0].update(own)
                if label is not None:
                    words[2 - label].update(own)
                if len(words[0]) > MEMORY_WORDS:
                    yield from flushed(words)
        yield from flushed(words)

    return (
        docs.select("text", "_class")
        .mapInArrow(run, GRAMS)
        .groupBy("gram")
        .agg(*[F.sum(n).alias(n) for n in ("n_all", "n_toxic", "n_ordinary")])
    )


@dataclass
class Model:
    """Log-likelihood ratios of the n-grams seen with a label, by hash.

    For an n-gram of neither class both models fall back on the shared one,
    whose probability cancels out: the ratio is that of the masses which the
    classes give to it after the history, and 0 after a history of neither.
    """

    order: int
    gram_keys: np.ndarray
    gram_ratios: np.ndarray
    history_keys: np.ndarray
    history_ratios: np.ndarray

    def word_ratios(self, words: list[str]) -> np.ndarray:
        grams = Grams(words, self.order)
        own, found = _looked_up(self.gram_keys, self.gram_ratios, grams.hashes())
        rare = np.flatnonzero(~found)
        histories = range_hashes(grams.values, grams.start[rare], grams.end[rare] - 1)
        own[rare], _ = _looked_up(self.history_keys, self.history_ratios, histories)
        return np.bincount(grams.owner, weights=own, minlength=len(words))


def code_points(text: str) -> np.ndarray:
    # Lone surrogates cannot be in a text of Spark, but may be in one given directly.
    return mixed(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) + np.uint64(1))


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the wanted keys, 0 for others, and which were found."""
    if not len(keys):
        return np.zeros(len(wanted)), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    found = keys[at] == wanted
    return np.where(found, values[at], 0.0), found


def _hashed(texts: list[str], ratios: list[float]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(lengths)
    keys = range_hashes(code_points("".join(texts)), ends - lengths, ends)
    order = np.argsort(keys)
    return keys[order], np.array(ratios, dtype=np.float64)[order].astype(np.float32)


def shared_model(counts: DataFrame, order: int = ORDER, discount: float = SHARED_DISCOUNT) -> DataFrame:
    """P of the last character after the others, for each n-gram below ``order``: (gram, p).

    An n-gram counts the different characters before it in all documents. With c
    its count, P = (c - min(c, D)) / c(h) + sum of min(c, D) over h / c(h) * P of
    the n-gram without its first character; below single characters all are equal.
    """
    tails = F.expr("transform(sequence(1, length(gram)), i -> substring(gram, i))")
    tails = counts.where("n_all > 0").select(F.explode(tails).alias("tail")).distinct()
    parts = tails.where("length(tail) > 1").groupBy(F.expr("substring(tail, 2)").alias("gram"))
    parts = parts.agg(F.count(F.lit(1)).alias("n")).withColumn("history", F.expr("substring(gram, 1, length(gram) - 1)"))
    off = F.least(F.col("n"), F.lit(discount))
    sums = parts.groupBy("history").agg(F.sum("n").alias("of"), F.sum(off).alias("held"))
    parts = parts.join(sums, "history").select(
        "gram", ((F.col("n") - off) / F.col("of")).alias("own"), (F.col("held") / F.col("of")).alias("held")
    )
    parts = snapshot(parts, "continuations")
    singles = parts.where("length(gram) = 1")
    level = singles.select("gram", (F.col("own") + F.col("held") / F.lit(max(1, singles.count()))).alias("p"))
    levels = level
    for size in range(2, order):
        below = level.select(F.col("gram").alias("lower"), F.col("p").alias("below"))
        level = parts.where(F.length("gram") == size).withColumn("lower", F.expr("substring(gram, 2)")).join(below, "lower")
        level = snapshot(level.select("gram", (F.col("own") + F.col("held") * F.col("below")).alias("p")), "shared-order")
        levels = levels.union(level)
    return levels


def class_models(
    counts: DataFrame, order: int = ORDER, discount: float = DISCOUNT
) -> tuple[DataFrame, DataFrame]:
    """Both classes: (gram, p_toxic, p_ordinary) of n-grams seen with a label, (history, held_toxic, held_ordinary).

    P(c | h) = (n(hc) - min(n(hc), D)) / n(h) + held(h) * P of the shared model,
    held(h) = sum of min(n(hc), D) / n(h), or 1 for a history that the class lacks.
    """
    labelled = counts.where("n_toxic + n_ordinary > 0").select(
        "gram", "n_toxic", "n_ordinary", F.expr("substring(gram, 1, length(gram) - 1)").alias("history")
    )
    totals = labelled.agg(F.sum("n_toxic"), F.sum("n_ordinary")).first()
    least = min([t for t in totals if t], default=1)
    own, sums = {}, []
    for name, total in zip(("toxic", "ordinary"), totals):
        n = F.col(f"n_{name}") * F.lit(least / total if total else 1.0)
        own[name] = n - F.least(n, F.lit(discount))
        sums += [F.sum(n).alias(f"of_{name}"), F.sum(F.least(n, F.lit(discount))).alias(f"off_{name}")]
    histories = labelled.groupBy("history").agg(*sums)
    for name in own:
        share = F.when(F.col(f"of_{name}") > 0, F.col(f"off_{name}") / F.col(f"of_{name}")).otherwise(1.0)
        histories = histories.withColumn(f"held_{name}", share)
    histories = snapshot(histories, "histories")
    base = shared_model(counts, order).select(F.col("gram").alias("_lower"), F.col("p").alias("_base"))
    grams = labelled.join(histories, "history").withColumn("_lower", F.expr("substring(gram, 2)")).join(base, "_lower")
    p = {
        name: F.when(F.col(f"of_{name}") > 0, value / F.col(f"of_{name}")).otherwise(0.0)
        + F.col(f"held_{name}") * F.col("_base")
        for name, value in own.items()
    }
    grams = grams.select("gram", *[value.alias(f"p_{name}") for name, value in p.items()])
    return grams, histories.select("history", "held_toxic", "held_ordinary")


def fit_model(counts: DataFrame, order: int = ORDER, discount: float = DISCOUNT) -> Model:
    """The log-likelihood ratios of both classes; ``counts`` are read several times."""
    grams, histories = class_models(counts, order, discount)
    grams = grams.select("gram", F.log(F.col("p_toxic") / F.col("p_ordinary")).alias("ratio")).toArrow()
    histories = histories.select("history", F.log(F.col("held_toxic") / F.col("held_ordinary")).alias("ratio")).toArrow()
    return Model(
        order,
        *_hashed(grams["gram"].to_pylist(), grams["ratio"].to_pylist()),
        *_hashed(histories["history"].to_pylist(), histories["ratio"].to_pylist()),
    )


def counted_sample(
    docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, entries: int = MODEL_ENTRIES
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sample, the documents with their place in it, and the n-gram counts of all documents."""
    while True:
        sample = fit_sample(labels, rows)
        # At most 2 x rows ids: a bounded broadcast.
        sampled = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id", "left")
        counting = F.when(fold(F.col("doc_id")) != 4, F.col("toxic"))
        counts = snapshot(count_grams(sampled.withColumn("_class", counting)), "grams")
        if rows == 1 or counts.where("n_toxic + n_ordinary > 0").count() <= entries:
            return sample, sampled, counts
        rows //= 2


def features(ratios: np.ndarray) -> list[float]:
    """Length-normalised ratios of one document from those of its words."""
    if not len(ratios):
        ratios = np.zeros(1)
    strong = int((ratios > STRONG).sum())
    return [
        float(ratios.mean()),
        float(np.clip(ratios, -2, 2).mean()),
        float(np.clip(ratios - 2, 0, 3).mean()),
        strong / (len(ratios) + 5),
        float(np.sqrt(strong / len(ratios))),
    ]


class Scorer:
    """Features of texts; ratios of words are remembered."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def features(self, texts: list[str]) -> Iterator[list[float]]:
        for part in batches(texts, len):
            words = [text.lower().split() for text in part]
            unknown = list(set().union(*words) - self.known.keys())
            if len(self.known) + len(unknown) > MEMORY_WORDS:
                self.known.clear()
                unknown = list(set().union(*words))
            if unknown:
                self.known.update(zip(unknown, self.model.word_ratios(unknown).tolist()))
            known = self.known
            for own in words:
                yield features(np.array([known[w] for w in own], dtype=np.float64))


def logistic_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights and intercept of a ridge logistic regression on raw features."""
    mean, spread = np.average(x, axis=0, weights=weight), x.std(axis=0) + 1e-9
    z = np.c_[(x - mean) / spread, np.ones(len(x))]
    w, total = np.zeros(z.shape[1]), weight.sum()
    penalty = ridge * total * np.diag([1.0] * x.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(
            (z * (weight * p * (1 - p))[:, None]).T @ z + penalty, z.T @ (weight * (y - p)) - penalty @ w
        )
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return np.r_[w[:-1] / spread, w[-1] - (w[:-1] * mean / spread).sum()]


def score(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Add ``toxic_score`` (0 to 1) to documents with ``doc_id`` and ``text``."""
    spark = docs.sparkSession
    sample, sampled, counts = counted_sample(docs, labels, fit_rows)
    model = spark.sparkContext.broadcast(fit_model(counts))

    schema = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType()))])
    held_back = sampled.where((fold(F.col("doc_id")) == 4) & F.col("toxic").isNotNull())

    def described(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for batch in parts:
            x = list(scorer.features([t or "" for t in batch.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.list_(pa.float64())), batch.column("toxic"), batch.column("weight")],
                ["x", "toxic", "weight"],
            )

    rows = (
        held_back.select("text", "toxic", "weight")
        .mapInArrow(described, schema.add("toxic", T.IntegerType()).add("weight", T.DoubleType()))
        .toArrow()
    )
    x = np.array(rows["x"].to_pylist(), dtype=np.float64).reshape(len(rows), FEATURES)
    y, weight = rows["toxic"].to_numpy(), rows["weight"].to_numpy()
    if len(set(y.tolist())) == 2:
        fitted = logistic_fit(x, y, weight)
    else:
        share = sample.agg(F.sum(F.col("toxic") * F.col("weight")) / F.sum("weight")).first()[0] or 0.0
        odds = np.clip(share, 1e-6, 1 - 1e-6)
        fitted = np.r_[np.zeros(FEATURES), np.log(odds / (1 - odds))]

    kept = [f for f in docs.schema.fields if f.name.lower() != "toxic_score"]
    out = T.StructType([*kept, T.StructField("toxic_score", T.DoubleType())])

    def scored(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for batch in parts:
            with no_cycles():
                x = np.array(list(scorer.features([t or "" for t in batch.column("text").to_pylist()])))
            value = 1 / (1 + np.exp(-np.clip(x.reshape(-1, FEATURES) @ fitted[:-1] + fitted[-1], -30, 30)))
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(value)], [f.name for f in out.fields])

    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(scored, out)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction of all documents, learned from labels outside fold 0."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, labels).select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        F.col("toxic_score").alias("score"),
        F.when(F.col("toxic_score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
