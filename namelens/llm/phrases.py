"""Collocations: phrases much more frequent than their parts would have it.

Texts are cut into pieces and pieces into words. A word's label hashes it with
its language, so phrases of different languages never meet. Counting goes from
short to long: a phrase can only be frequent if the words, then the pairs in it
are. Each task sorts the phrases of its texts and builds a count automaton of
them (``automata``), cut by ranges of their hashed prefix; the automata of a
range are united, which sums the counts, and what is frequent comes out. To score
a phrase its parts are read by the automata of all frequent phrases, again range
by range.

What is frequent is told to the tasks by a bitmap of fixed size. A bit that two
labels share costs a phrase counted in vain and changes no result, so neither
the bitmap nor any group grows with a hot word: a pair of words that makes up a
third of the corpus is one phrase of each shard. A range holds the different
phrases of some prefixes, about as many as ``RANGE_WORDS`` words have; requests
to a range are spread over several tasks if there are many.

Labels have 64 bits: two words of one language share one with a probability of
V**2 / 2**65 for V different words (10**9 words: 3 %).

Null texts have no words, a null language is ``und``. Texts of any length are
read whole, in parts of whole documents. Repeated rows count as often as they
occur. An empty table has no phrases. Only ``text`` and ``lang`` are read, so no
other column of the caller can clash; phrases are the result, not documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from namelens.llm.automata import CountAutomaton, united
from namelens.llm.counting import ShardCounts, sort_rows
from namelens.llm.stored import stored
from namelens.llm.words import Words, batches, mixed, words_of
from namelens.operators.joins import keyed_join

LEAST = 100
LONGEST = 5
TOP = 2000
# What ends a piece, besides the end of the text.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"

# The bitmap that tells frequent phrases has 2**BITMAP bits.
BITMAP = 27
# Words of the corpus whose phrases a range holds.
RANGE_WORDS = 1 << 21
# Phrases that a task holds before it writes them as automata.
SHARD_PHRASES = 1 << 21
# Requests that one task reads.
REQUESTS = 1 << 17

WORDS = "label bigint, lang string, word string, n bigint"
SHARDS = "range int, automaton binary"
PHRASES = "size int, labels array<bigint>, a bigint"

_FOLD = bytes(0x0A if b in PIECE_ENDS else b + 32 if 65 <= b <= 90 else b for b in range(256))
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def _lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def labelled(texts: list[bytes], langs: list[str]) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """The words of texts, the label and the piece of each word, and the text it is in."""
    # Text ends and piece ends are line feeds now, which never are in a word.
    data = b"\n".join(t.translate(_FOLD) for t in texts) + b"\n"
    words = words_of([data])
    ends = np.cumsum(np.frombuffer(data, dtype=np.uint8) == 0x0A)
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    owner = np.searchsorted(offsets, words.starts, side="right") - 1
    own = np.array([_lang_hash(x) for x in langs], dtype=np.uint64)
    labels = mixed(words.hashes + own[owner]) if len(words.hashes) else words.hashes
    return words, np.maximum(labels, np.uint64(1)), ends[words.starts] if len(words.starts) else words.starts, owner


def _text_parts(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], list[str]]]:
    texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
    langs = ["und" if x is None else x for x in batch.column("lang").to_pylist()]
    for part in batches(list(zip(texts, langs)), lambda r: len(r[0])):
        yield [t for t, _ in part], [x for _, x in part]


def count_words(docs: DataFrame) -> DataFrame:
    """Every word of every language with its label and count."""

    def rows(shard: ShardCounts) -> pa.RecordBatch:
        labels, spelled, counts = shard.rows()
        return pa.RecordBatch.from_arrays([pa.array(labels.view(np.int64)), *spelled, pa.array(counts)], ["label", "lang", "word", "n"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = ShardCounts()
        for batch in parts:
            for texts, langs in _text_parts(batch):
                words, labels, _, owner = labelled(texts, langs)
                shard.add(labels, lambda at: ([langs[i] for i in owner[at].tolist()], words.at(at)))
                if shard.full:
                    yield rows(shard)
                    shard = ShardCounts()
        if len(shard.known):
            yield rows(shard)

    rows = docs.select("text", "lang").mapInArrow(run, WORDS)
    return rows.groupBy("label", "lang", "word").agg(F.sum("n").alias("n"))


def bitmap(keys: DataFrame) -> np.ndarray:
    """A bit for every ``key``, in words of 64 bits: of one size, however many keys there are."""
    shift = 64 - BITMAP
    cells = keys.groupBy(F.expr(f"shiftrightunsigned(key, {shift + 6})").alias("cell")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(key, {shift}) & 63 as int)))").alias("bits")
    )
    found = cells.toArrow()
    out = np.zeros(1 << (BITMAP - 6), dtype=np.uint64)
    out[found["cell"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def _marked(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys >> np.uint64(64 - BITMAP)
    return (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mixed(left * _PAIR + right)


def candidate_phrases(labels: np.ndarray, pieces: np.ndarray, bits: np.ndarray, longest: int) -> np.ndarray:
    """From each word on, the longest row of up to ``longest`` words that may be frequent.

    For pairs ``bits`` marks frequent words, for longer phrases frequent pairs,
    and rows of three words or more are given.
    """
    n = len(labels)
    if n < 2:
        return np.zeros((0, longest), dtype=np.uint64)
    joined = pieces[1:] == pieces[:-1]
    if longest == 2:
        good = _marked(bits, labels)
        joined &= good[1:] & good[:-1]
    else:
        at = np.flatnonzero(joined)
        joined[at] = _marked(bits, pair_keys(labels[at], labels[at + 1]))
    joined = np.r_[joined, np.zeros(longest, dtype=bool)]
    going = joined[:n].copy()
    if longest > 2:
        going &= joined[1 : n + 1]
    starts = np.flatnonzero(going)
    rows = np.zeros((len(starts), longest), dtype=np.uint64)
    rows[:, 0] = labels[starts]
    alive = np.ones(len(starts), dtype=bool)
    for k in range(1, longest):
        alive &= joined[starts + k - 1]
        rows[alive, k] = labels[starts[alive] + k]
    return rows


def prefix_range(phrases: np.ndarray, ranges: int) -> np.ndarray:
    """The range of a phrase by a hash of its first three words, or two where it has no more."""
    key = pair_keys(phrases[:, 0], phrases[:, 1])
    if phrases.shape[1] > 2:
        key = pair_keys(key, phrases[:, 2])
    return ((key >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def shard_automata(docs: DataFrame, bits: np.ndarray, longest: int, ranges: int) -> DataFrame:
    """The count automata of every task's phrases, one for each range of prefixes."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        return sort_rows(np.concatenate([r for r, _ in held]), np.concatenate([c for _, c in held]))

    def written(rows: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        own = prefix_range(rows, ranges)
        order = np.argsort(own, kind="stable")
        rows, counts, own = rows[order], counts[order], own[order]
        edges = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        built = [
            CountAutomaton.from_sorted(rows[a:b], counts[a:b]).to_bytes() for a, b in zip(edges, np.r_[edges[1:], len(own)])
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array(own[edges].astype(np.int32)), pa.array(built, pa.binary())], ["range", "automaton"]
        )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in parts:
            for texts, langs in _text_parts(batch):
                _, labels, pieces, _ = labelled(texts, langs)
                rows = candidate_phrases(labels, pieces, sent.value, longest)
                if not len(rows):
                    continue
                held.append(sort_rows(rows, np.ones(len(rows), dtype=np.int64)))
                size += len(held[-1][0])
                if size < SHARD_PHRASES:
                    continue
                held = [merged(held)]
                size = len(held[0][0])
                # Merged again and again it would take time, so it goes when half is different.
                if 2 * size >= SHARD_PHRASES:
                    yield from written(*held[0])
                    held, size = [], 0
        if held:
            yield from written(*merged(held))

    return docs.select("text", "lang").mapInArrow(run, SHARDS)


def _phrase_rows(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    sizes, labels, counts = [], [], []
    for rows, own in parts:
        width = rows.shape[1]
        offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
        sizes.append(np.full(len(rows), width, dtype=np.int32))
        labels.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel().view(np.int64))))
        counts.append(own.astype(np.int64))
    return pa.table(
        {
            "size": pa.array(np.concatenate(sizes)) if sizes else pa.array([], pa.int32()),
            "labels": pa.chunked_array(labels, pa.list_(pa.int64())),
            "a": pa.array(np.concatenate(counts)) if counts else pa.array([], pa.int64()),
        }
    )


def frequent_phrases(shards: DataFrame, least: int, longest: int) -> DataFrame:
    """Phrases with a count of ``least`` or more in the united automata of all shards."""
    shortest = min(longest, 3)

    def unite(table: pa.Table) -> pa.Table:
        automata = (CountAutomaton.from_bytes(a) for a in table.column("automaton").to_pylist())
        return _phrase_rows(united(automata, longest).frequent(least, shortest))

    return shards.groupBy("range").applyInArrow(unite, PHRASES)


def count_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words (label, lang, word, n), frequent phrases (size, labels, a) with the words as size 1,
    and the number of words of every language (lang, n)."""
    spark = docs.sparkSession
    words = stored(count_words(docs), "words")
    totals = stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "languages")
    corpus = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(partitions, corpus // RANGE_WORDS)
    frequent = stored(words.where(F.col("n") >= least), "frequent-words")
    phrases = frequent.select(F.lit(1).alias("size"), F.array("label").alias("labels"), F.col("n").alias("a"))
    keys = frequent.select(F.col("label").alias("key"))
    for size in [2, longest] if longest > 2 else [2]:
        shards = shard_automata(docs, bitmap(keys), size, ranges)
        found = stored(frequent_phrases(shards, least, size), "phrases")
        phrases = phrases.unionByName(found)
        if size == 2:
            keys = keyed_pairs(found)
    return frequent, phrases, totals


def keyed_pairs(pairs: DataFrame) -> DataFrame:
    """``key`` of every pair of words, as the tasks compute it."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            both = batch.column("labels").flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pair_keys(both[:, 0], both[:, 1]).view(np.int64))], ["key"])

    return pairs.select("labels").mapInArrow(run, "key bigint")


def _filled(lists: pa.Array, depth: int) -> np.ndarray:
    """Label lists as rows filled up with 0."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), depth), dtype=np.uint64)
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), place] = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    return out


def part_counts(phrases: DataFrame, longest: int = LONGEST) -> DataFrame:
    """For every phrase of two words or more and every cut: ``l`` and ``r``, the counts of its two parts.

    Parts of frequent phrases are frequent, so the automata of all frequent
    phrases know them. A range's automaton goes to as many tasks as its requests need.
    """
    phrases = stored(phrases, "all-phrases")
    spark = phrases.sparkSession
    total = phrases.count()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // REQUESTS)

    def placed(df: DataFrame, part: str) -> DataFrame:
        # By the first two words: one word alone has a place of its own.
        return df.withColumn("range", F.pmod(F.xxhash64(F.slice(part, 1, 2)), F.lit(ranges)).cast("int"))

    def build(table: pa.Table) -> pa.Table:
        rows, counts = _filled(table.column("labels"), longest), table.column("a").to_numpy()
        order = np.lexsort(rows.T[::-1])
        automaton = CountAutomaton.from_sorted(rows[order], counts[order], summed=False)
        return pa.table({"range": table.column("range")[:1], "automaton": pa.array([automaton.to_bytes()], pa.binary())})

    cuts = F.explode(F.sequence(F.lit(1), F.col("size") - 1))
    cut = phrases.where("size > 1").select("labels", cuts.alias("k"), "size")
    left, right = F.slice("labels", F.lit(1), F.col("k")), F.slice("labels", F.col("k") + 1, F.col("size") - F.col("k"))
    sides = F.inline(F.array(*[F.struct(F.lit(s).alias("side"), p.alias("part")) for s, p in (("l", left), ("r", right))]))
    requests = stored(placed(cut.select("labels", "k", sides), "part"), "requests")
    copies = F.ceil(F.count(F.lit(1)) / REQUESTS).cast("int")
    # One row a range.
    many = stored(requests.groupBy("range").agg(copies.alias("copies")), "copies")
    spread = F.pmod(F.xxhash64("labels", "k", "side"), F.col("copies")).cast("int")
    requests = requests.join(many, "range").withColumn("copy", spread)
    built = stored(placed(phrases, "labels").groupBy("range").applyInArrow(build, SHARDS), "count-automata")
    copied = built.join(many, "range").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))

    def read(asked: pa.Table, held: pa.Table) -> pa.Table:
        parts = _filled(asked.column("part"), longest)
        found = np.zeros(len(parts), dtype=np.int64)
        for automaton in held.column("automaton").to_pylist():
            found = CountAutomaton.from_bytes(automaton).lookup(parts)
        return asked.select(["labels", "k", "side"]).append_column("f", pa.array(found))

    answers = (
        requests.groupBy("range", "copy")
        .cogroup(copied.select("range", "copy", "automaton").groupBy("range", "copy"))
        .applyInArrow(read, "labels array<bigint>, k int, side string, f bigint")
    )
    sides = [F.max(F.when(F.col("side") == s, F.col("f"))).alias(s) for s in ("l", "r")]
    return answers.groupBy("labels", "k").agg(*sides)


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP
) -> DataFrame:
    """The ``top`` phrases of every language with their counts, those of the deciding cut's parts, and the score."""
    words, phrases, totals = count_phrases(docs, least, longest)
    phrases = stored(phrases, "frequent")
    candidates = phrases.where("size > 1")
    parts = stored(part_counts(phrases, longest).join(candidates, "labels"), "parts")

    # A phrase goes if one word more, before or after it, leaves its count as it is:
    # then so do all longer ones that it is inside of with the same count.
    longer = parts.where("size > 2")
    inside = longer.where("k = size - 1 and l = a").select(F.expr("slice(labels, 1, size - 1)").alias("labels"))
    inside = inside.union(longer.where("k = 1 and r = a").select(F.expr("slice(labels, 2, size - 1)")))
    own = parts.join(inside.distinct(), "labels", "left_anti")

    # Spelled word by word; a phrase has at most ``longest`` of them.
    spelled = keyed_join(
        own.where("k = 1").select("labels", F.posexplode("labels").alias("place", "label")),
        words.select("label", "lang", "word"),
        ["label"],
        "inner",
    )
    spelled = spelled.groupBy("labels").agg(
        F.min("lang").alias("lang"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda w: w["word"]), " "
        ).alias("phrase"),
    )
    rows = own.join(spelled, "labels").join(totals, "lang")
    whole = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "n", "l", "r")}
    numbers = rows.withColumns({f"_{c}": v for c, v in whole.items()})
    cut = F.expr("((1000 * _a) * _n) div (_l * _r)")
    lowest = numbers.groupBy("labels", "lang", "phrase", "a", "n").agg(
        F.min(F.struct(cut.alias("score"), "k", "l", "r")).alias("cut")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    ranked = lowest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of every language."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang"))


def op11_sql() -> str:
    """The same from all phrases of all documents."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), worded as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), grams as (
  select lang, size, array_to_string(w[i:i + size - 1], ' ') as phrase
  from (
    select lang, w, size, unnest(range(1, len(w) - size + 2)) as i
    from worded, (select unnest(range(1, {LONGEST} + 1)) as size) where len(w) >= size
  )
), counted as (
  select lang, size, phrase, count(*) as f from grams group by all
), totals as (
  select lang, cast(sum(f) as bigint) as n from counted where size = 1 group by lang
), frequent as (
  select * from counted where f >= {LEAST}
), cuts as (
  select lang, size, phrase, f as a, string_split(phrase, ' ') as w, unnest(range(1, size)) as k
  from frequent where size > 1
), scored as (
  select c.lang, c.size, c.phrase, c.a, c.k, x.f as l, y.f as r, t.n,
    cast(cast(1000 as hugeint) * c.a * t.n // (cast(x.f as hugeint) * y.f) as bigint) as score
  from cuts c
  join totals t on t.lang = c.lang
  join frequent x on x.lang = c.lang and x.size = k and x.phrase = array_to_string(w[1:k], ' ')
  join frequent y on y.lang = c.lang and y.size = c.size - k and y.phrase = array_to_string(w[k + 1:], ' ')
), lowest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), kept as (
  select * from lowest p where not exists (
    select 1 from frequent q where q.lang = p.lang and q.size > p.size and 100 * q.f >= 100 * p.a
      and contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' '))
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept qualify rank <= {TOP}"""
