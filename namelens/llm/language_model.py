"""Log-probabilities of texts under a log-bilinear neural language model.

Tokens are lower-cased words and one end a text. The model predicts a token's
unit from those of the two tokens before it: the score of a unit is the product
of its vector with the sum of the context's vectors, each through the matrix of
its place, plus a bias. The most frequent words and the end are units of their
own; any other word belongs to the unit of its last two characters, or to the one
for all other endings. Within its unit a word has its smoothed share of the unit's
counts, with one share kept for an unknown word, so the probabilities of all known
words and an unknown one sum to one after every context.

Counts, shares and the base score cover all training texts: the words are counted
by Spark, and words that are not among the most frequent are joined with their
counts. The vectors are learned by noise-contrastive estimation in numpy, in
rounds over all training texts: each task learns from its texts, and the tasks'
parameters are averaged by their numbers of tokens. The parameters have the size
of the units, which does not grow with the corpus. The sum over all units, for every
context at once, is one matrix product.

Null and empty texts have one token, their end. Texts of any length are scored
whole. A null id counts as an empty one for the choice of training texts. Repeated
rows are scored one by one. Without training texts the model is uniform over its
one unit and nothing is known; an empty table gives no rows. Results carry all
columns of the caller but the text; a column of the name of a result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namelens.llm.counting import ShardCounts, sort_rows
from namelens.llm.rows import ROW, kept_columns, row_field, unpacked
from namelens.llm.stored import stored
from namelens.llm.toxicity import fold
from namelens.llm.words import batches, words_of

HELD_OUT = 1
# Units that are words, and units that are endings; one more each for the end and all else.
OWN_WORDS, ENDINGS = 383, 127
END = 0
# Words whose counts all tasks have: at most so many, the others are joined.
SENT_WORDS = 1 << 18
DIMENSIONS = 16
# Noise samples, shared by the tokens of a step, and tokens of a step.
NOISE, STEP = 64, 1024
RATE = 0.1
# Each round learns from the texts of one part; every text is learned from ``EPOCHS`` times.
PARTS, EPOCHS = 4, 1

ADDED = ["n_tokens", "n_known", "base_score", "score"]
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == HELD_OUT


def _text_parts(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    rows = [(i, (t or "").encode().translate(_FOLD)) for i, t in enumerate(texts.to_pylist())]
    for part in batches(rows, lambda r: len(r[1])):
        yield part[0][0], [t for _, t in part]


def count_words(texts: DataFrame) -> DataFrame:
    """Every different word of ``text`` with its count ``n``."""

    def rows(shard: ShardCounts) -> pa.RecordBatch:
        _, spelled, counts = shard.rows()
        return pa.RecordBatch.from_arrays([*spelled, pa.array(counts)], ["word", "n"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = ShardCounts()
        for batch in parts:
            for _, part in _text_parts(batch.column("text")):
                words = words_of(part)
                shard.add(words.hashes, lambda at: (words.at(at),))
                if shard.full:
                    yield rows(shard)
                    shard = ShardCounts()
        if len(shard.known):
            yield rows(shard)

    counted = texts.select("text").mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Units:
    """The units, their masses and the most frequent words."""

    tokens: int
    different: int
    endings: dict[str, int]
    # log10 of the summed counts of a unit with its smoothing; 0 where the unit is one word.
    masses: np.ndarray
    counts: np.ndarray
    hashes: np.ndarray
    word_counts: np.ndarray
    word_units: np.ndarray

    @property
    def size(self) -> int:
        return len(self.masses)

    def of_word(self, word: str) -> int:
        """The unit of a word that is none of its own."""
        return self.endings.get(word[-2:], self.size - 1)


def _sent(words: DataFrame) -> tuple[Column, int]:
    """Which words all tasks get: as many classes of frequency, from the top, as fit into ``SENT_WORDS``."""
    level = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    # A few hundred rows at any size.
    rows = words.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect()
    held, least = 0, 1 << 30
    for row in rows:
        held += row["n"]
        if held > SENT_WORDS:
            break
        least = row["level"]
    return level >= least, least


def fit_units(words: DataFrame, texts: int) -> tuple[Units, Column]:
    """Units from counted ``words`` of so many ``texts``, and which words all tasks have."""
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = words.orderBy(F.desc("n"), "word").limit(OWN_WORDS).collect()
    own = {r["word"]: i for i, r in enumerate(top, 1)}
    # Bounded lists: words and endings that are units.
    spark = words.sparkSession
    named = spark.createDataFrame(list(own.items()), "word string, unit int")
    rest = words.join(F.broadcast(named), "word", "left_anti").withColumn("ending", F.expr("right(word, 2)"))
    counted = rest.groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"))
    counted = stored(counted, "endings")
    first = counted.orderBy(F.desc("n"), "ending").limit(ENDINGS).collect()
    endings = {r["ending"]: len(own) + i for i, r in enumerate(first, 1)}
    size = 1 + len(own) + len(endings) + 1
    counts = np.zeros(size)
    counts[END] = texts
    for r in top:
        counts[own[r["word"]]] = r["n"]
    masses = np.zeros(size)
    seen = np.zeros(2)
    for r in first:
        counts[endings[r["ending"]]] = r["n"]
        masses[endings[r["ending"]]] = np.log10(r["n"] + 0.5 * r["v"] + 0.5)
        seen += r["n"], r["v"]
    everything = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    left = np.array([everything[0], everything[1]]) - seen
    counts[-1] = left[0]
    masses[-1] = np.log10(left[0] + 0.5 * left[1] + 0.5)

    sent, _ = _sent(words)
    frequent = words.where(sent).toArrow()
    data = words_of([w.encode() for w in frequent["word"].to_pylist()])
    order = np.argsort(data.hashes)
    units = Units(total["n"] + texts, total["v"] + (texts > 0), endings, masses, counts, data.hashes[order], *[np.zeros(0)] * 2)
    units.word_counts = frequent["n"].to_numpy()[order]
    kinds = [own.get(w) or units.of_word(w) for w in frequent["word"].to_pylist()]
    units.word_units = np.array(kinds, dtype=np.uint16)[order]
    return units, sent


def encode(rows: DataFrame, units: Units, row: T.StructField, flags: list[str]) -> DataFrame:
    """Units of all tokens, what is known of their logarithms, and the words whose counts are to be joined."""
    sent = rows.sparkSession.sparkContext.broadcast(units)
    words_type = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.IntegerType())]))
    schema = T.StructType(
        [
            row,
            *[rows.schema[f] for f in flags],
            T.StructField("units", T.BinaryType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("log_counts", T.DoubleType()),
            T.StructField("log_shares", T.DoubleType()),
            T.StructField("rare", words_type),
        ]
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        end = np.log10(own.counts[END] + 0.5)
        known_logs = np.log10(own.word_counts + 0.5)
        for batch in parts:
            for start, texts in _text_parts(batch.column("text")):
                words = words_of(texts)
                n, total = len(texts), len(words.hashes)
                sizes = np.diff(words.first)
                owner = np.repeat(np.arange(n), sizes)
                place = np.searchsorted(own.hashes, words.hashes)
                found = np.zeros(total, dtype=bool)
                inside = place < len(own.hashes)
                found[inside] = own.hashes[place[inside]] == words.hashes[inside]
                unit = np.zeros(total, dtype=np.uint16)
                unit[found] = own.word_units[place[found]]
                # The other words, each once a text.
                other = np.flatnonzero(~found)
                hashes, index, inverse = np.unique(words.hashes[other], return_index=True, return_inverse=True)
                spelled = words.at(other[index])
                unit[other] = np.array([own.of_word(w[-8:].decode(errors="ignore")) for w in spelled], dtype=np.uint16)[inverse]
                pairs, times = sort_rows(
                    np.stack((owner[other].astype(np.uint64), inverse.astype(np.uint64)), axis=1), np.ones(len(other), dtype=np.int64)
                )
                offsets = np.searchsorted(pairs[:, 0], np.arange(n + 1)).astype(np.int32)
                names = pa.array(spelled, pa.string()).take(pa.array(pairs[:, 1].astype(np.int64)))
                rare = pa.ListArray.from_arrays(
                    pa.array(offsets), pa.StructArray.from_arrays([names, pa.array(times.astype(np.int32))], ["word", "n"])
                )
                logs = np.zeros(total)
                logs[found] = known_logs[place[found]]
                shared = own.masses[unit] != 0
                parts_of = (found, logs, np.where(shared, logs - own.masses[unit], 0.0))
                sums = [np.bincount(owner, weights=w, minlength=n).astype(np.float64) for w in parts_of]
                stream = np.full(total + n, END, dtype="<u2")
                stream[np.arange(total) + owner] = unit
                cuts = 2 * np.r_[0, np.cumsum(sizes + 1)]
                data = stream.tobytes()
                out = batch.slice(start, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        out.column(ROW),
                        *[out.column(f) for f in flags],
                        pa.array([data[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary()),
                        pa.array(sizes + 1),
                        pa.array(sums[0].astype(np.int64) + int(own.counts[END] > 0)),
                        pa.array(sums[1] + end),
                        pa.array(sums[2]),
                        rare,
                    ],
                    schema.fieldNames(),
                )

    return rows.select(ROW, *flags, "text").mapInArrow(run, schema)


def contexts(units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The tokens' units, those one and two before, and where texts begin; before a text there are ends."""
    parts = units.to_pylist()
    stream = np.frombuffer(b"".join(parts), dtype="<u2").astype(np.int64)
    starts = np.cumsum([0] + [len(p) // 2 for p in parts[:-1]])[: len(parts)]
    one = np.r_[END, stream[:-1]] if len(stream) else stream
    two = np.r_[END, one[:-1]] if len(stream) else stream
    one[starts] = END
    two[starts] = END
    return stream, one, two, starts


@dataclass
class Parameters:
    """Vectors of context units, vectors and biases of predicted ones, a matrix for each place."""

    read: np.ndarray
    said: np.ndarray
    bias: np.ndarray
    near: np.ndarray
    far: np.ndarray

    NAMES = ("read", "said", "bias", "near", "far")

    @classmethod
    def start(cls, counts: np.ndarray, dimensions: int = DIMENSIONS) -> Parameters:
        rng = np.random.default_rng(20240229)
        n = len(counts)
        draw = lambda *shape: rng.standard_normal(shape) * 0.1
        eye = np.eye(dimensions)
        return cls(draw(n, dimensions), draw(n, dimensions), np.log(noise_shares(counts)), eye.copy(), eye / 2)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, name).ravel() for name in self.NAMES])

    def like(self, flat: np.ndarray) -> Parameters:
        out, place = [], 0
        for name in self.NAMES:
            old = getattr(self, name)
            out.append(flat[place : place + old.size].reshape(old.shape).copy())
            place += old.size
        return Parameters(*out)


def noise_shares(counts: np.ndarray) -> np.ndarray:
    smoothed = counts + 0.5
    return smoothed / smoothed.sum()


def nce_step(p: Parameters, word: np.ndarray, one: np.ndarray, two: np.ndarray, drawn: np.ndarray, noise: np.ndarray) -> Parameters:
    """The gradient of the mean noise-contrastive loss; ``noise`` has log(samples x share) of every unit."""
    n, k, size = len(word), len(drawn), len(p.bias)
    near, far = p.read[one], p.read[two]
    context = near @ p.near + far @ p.far
    said = p.said[word]
    true = (context * said).sum(axis=1) + p.bias[word] - noise[word]
    false = context @ p.said[drawn].T + (p.bias - noise)[drawn]
    g_true = -1 / (1 + np.exp(np.clip(true, -30, 30)))
    g_false = 1 / (1 + np.exp(-np.clip(false, -30, 30)))
    g_context = g_true[:, None] * said + g_false @ p.said[drawn]

    def spread(places: np.ndarray, values: np.ndarray) -> np.ndarray:
        cells = (places[:, None] * values.shape[1] + np.arange(values.shape[1])).ravel()
        return np.bincount(cells, weights=values.ravel(), minlength=size * values.shape[1]).reshape(size, -1)

    g_said = spread(np.r_[word, drawn], np.concatenate((g_true[:, None] * context, g_false.T @ context)))
    g_bias = spread(np.r_[word, drawn], np.r_[g_true, g_false.sum(axis=0)][:, None]).ravel()
    g_read = spread(np.r_[one, two], np.concatenate((g_context @ p.near.T, g_context @ p.far.T)))
    return Parameters(g_read / n, g_said / n, g_bias / n, near.T @ g_context / n, far.T @ g_context / n)


class Learner:
    """Steps of a task from given parameters; each parameter's rate falls with its own gradients."""

    def __init__(self, start: Parameters, squares: np.ndarray, counts: np.ndarray, seed: int):
        self.shape, self.flat, self.squares = start, start.flat(), squares.copy()
        self.rng = np.random.default_rng(seed)
        shares = noise_shares(counts)
        self.steps, self.noise = np.cumsum(shares), np.log(NOISE * shares)
        self.tokens = 0

    def learn(self, word: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        order = self.rng.permutation(len(word))
        for start in range(0, len(word), STEP):
            at = order[start : start + STEP]
            drawn = np.minimum(np.searchsorted(self.steps, self.rng.random(NOISE)), len(self.steps) - 1)
            gradient = nce_step(self.shape.like(self.flat), word[at], one[at], two[at], drawn, self.noise).flat()
            self.squares += gradient**2
            self.flat -= RATE * gradient / np.sqrt(self.squares + 1e-10)
        self.tokens += len(word)


def learn_round(texts: DataFrame, start: Parameters, squares: np.ndarray, counts: np.ndarray, number: int) -> tuple[Parameters, np.ndarray]:
    """Parameters after one round: the mean of the tasks' own, weighted by their tokens."""
    sent = texts.sparkSession.sparkContext.broadcast((start, squares, counts))
    size = len(squares)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = Learner(*sent.value, seed=number)
        for batch in parts:
            if batch.num_rows:
                word, one, two, _ = contexts(batch.column("units"))
                learner.learn(word, one, two)
        if learner.tokens:
            values = np.concatenate((learner.flat, learner.squares, [1.0])) * learner.tokens
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(2 * size + 1), pa.int32()), pa.array(values)], ["cell", "value"])

    cells = texts.select("units").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    # As many numbers as there are parameters, whatever the number of texts.
    found = cells.toArrow()
    if not len(found):
        return start, squares
    sums = np.zeros(2 * size + 1)
    sums[found["cell"].to_numpy()] = found["value"].to_numpy()
    sums /= sums[-1]
    return start.like(sums[:size]), sums[size:-1]


def learn(texts: DataFrame, counts: np.ndarray) -> Parameters:
    """Vectors from the ``units`` of texts with a ``part`` from 0 to ``PARTS`` - 1."""
    p = Parameters.start(counts)
    squares = np.zeros(len(p.flat()))
    for number in range(PARTS * EPOCHS):
        p, squares = learn_round(texts.where(F.col("part") == number % PARTS), p, squares, counts, number)
    return p


@dataclass
class Tables:
    """Scores of a unit after the unit before it and the one before that, and the log sums of all contexts."""

    near: np.ndarray
    far: np.ndarray
    sums: np.ndarray

    @classmethod
    def of(cls, p: Parameters) -> Tables:
        near, far = p.read @ p.near @ p.said.T + p.bias, p.read @ p.far @ p.said.T
        most_near, most_far = near.max(axis=1, keepdims=True), far.max(axis=1, keepdims=True)
        # The sum of exp(near + far) over all units, for every pair of units before.
        products = np.exp(near - most_near) @ np.exp(far - most_far).T
        with np.errstate(divide="ignore"):
            sums = np.log(products) + most_near + most_far.T
        # Contexts whose places disagree so much that the product loses its digits.
        for one, two in zip(*np.nonzero(products < 1e-250)):
            both = near[one] + far[two]
            sums[one, two] = both.max() + np.log(np.exp(both - both.max()).sum())
        return cls(near, far, sums)

    def log_probabilities(self, word: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.near[one, word] + self.far[two, word] - self.sums[one, two]


def unit_scores(rows: DataFrame, tables: Tables, passed: list[str]) -> DataFrame:
    """``log_units``: the log10 probability of the units of a text; ``passed`` columns are kept."""
    sent = rows.sparkSession.sparkContext.broadcast(tables)
    schema = T.StructType([*[rows.schema[c] for c in passed], T.StructField("log_units", T.DoubleType())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            if not batch.num_rows:
                continue
            word, one, two, starts = contexts(batch.column("units"))
            sums = np.add.reduceat(sent.value.log_probabilities(word, one, two), starts) / np.log(10)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in passed], pa.array(sums)], schema.fieldNames())

    return rows.select(*passed, "units").mapInArrow(run, schema)


@dataclass
class LanguageModel:
    units: Units
    parameters: Parameters
    tables: Tables


def score_texts(docs: DataFrame, text: str = "text", training: Column | None = None) -> tuple[DataFrame, LanguageModel]:
    """The rows without their text, with ``n_tokens``, ``n_known``, ``base_score`` and ``score``; and the model.

    ``training`` tells from the caller's columns which texts are learned from.
    """
    if training is None:
        training = ~held_out(F.col("doc_id"))
    names = [*ADDED, text]
    row = F.struct(*[F.col(f"`{c}`") for c in kept_columns(docs, names)]).alias(ROW)
    rows = docs.select(row, F.col(f"`{text}`").alias("text"), F.coalesce(training, F.lit(False)).alias("_training"))
    learned = rows.where("_training")
    words = stored(count_words(learned), "words")
    units, sent = fit_units(words, learned.count())
    flags = ["_training"]
    coded = encode(rows, units, row_field(docs, names), flags)
    coded = stored(coded.withColumn("_id", F.monotonically_increasing_id()), "units")
    part = F.pmod(F.xxhash64("_id"), F.lit(PARTS)).alias("part")
    parameters = learn(coded.where("_training").select("units", part), units.counts)
    model = LanguageModel(units, parameters, Tables.of(parameters))

    # Only words that the tasks did not have, each once a text.
    rare = coded.select("_id", F.inline("rare")).join(words.where(~sent).withColumnRenamed("n", "c"), "word", "left")
    rare = rare.groupBy("_id").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5))).alias("log_rare"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known_rare"),
    )
    scored = unit_scores(coded, model.tables, [ROW, "_id", "n_tokens", "n_known", "log_counts", "log_shares"])
    scored = scored.join(rare, "_id", "left")
    log_rare = F.coalesce("log_rare", F.lit(0.0))
    whole = float(np.log10(units.tokens + 0.5 * (units.different + 1)))
    added = {
        "n_tokens": F.col("n_tokens"),
        "n_known": F.col("n_known") + F.coalesce("known_rare", F.lit(0)),
        "base_score": F.col("log_counts") + log_rare - F.col("n_tokens") * F.lit(whole),
        "score": F.col("log_units") + F.col("log_shares") + log_rare,
    }
    return unpacked(scored, kept_columns(docs, names), added), model


def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base score and model score of all documents, learned from those outside fold 1."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows, model = score_texts(docs)
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(model.units.tokens)).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )
