"""Personal data: patterns of form, and contextual patterns learned by bootstrapping.

E-mail and IP addresses, card and phone numbers are found by their form. They
are the seeds: the word before and after a seed, and the key in ``key=value``,
are patterns. A graph joins patterns with the instances seen in them: seeds and
other words that look like identifiers. Its scores are iterated: a pattern is
as good as the share of all its occurrences in the corpus that hold good
instances, and an instance as good as its patterns together. Instances beside a
pattern with a high score are further spans, of kind ``id``. Words with a digit,
and the values of keys with or without one, look like identifiers, from
``LEAST_LENGTH`` characters on; keys and instances may have any length.

Null texts count as empty and have no spans. Very long texts, with or without
blanks, are walked through once. Positions are code points, the end
exclusive. Rows are judged one by one, so repeated rows get equal results; an
empty table gives an empty result. Other columns are passed on; added ones
replace columns of the same name.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namelens.llm.rows import kept_columns, keyed, packed, unpacked
from namelens.llm.stored import stored
from namelens.llm.words import no_cycles

KINDS = ("email", "ip", "card", "phone", "id")

ROUNDS = 3
# A pattern counts from this many different good instances on.
LEAST_INSTANCES = 3
# Share of a pattern's occurrences that must hold good instances.
PATTERN_SCORE = 0.5
INSTANCE_SCORE = 0.5
# Least length of an identifier that is not found by its form; the longest are as good as any.
LEAST_LENGTH = 5
MEMORY_WORDS = 200_000

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that fails at the first digit of a run fails at the others too.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NUMBER_WORD = re.compile(r"(?<!\S)[^\s0-9]*+[0-9]\S*")
_KEY = re.compile(r"([^\s=:]{2,}+)[=:]")
_KEYED_WORD = re.compile(r"(?<!\S)[^\s=:]{2,}+[=:]\S+")
# A longer word, key or instance is told from others by its hash.
LONG_WORD = 200
_EDGE = " \t\r\n.,;:!?\"'()[]{}<>|"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@`` on: linear in the text."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARACTERS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(free, at + 1))


def passes_luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all that is found by its form, in order."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in emails(text)]
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and passes_luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def _named(word: str) -> str:
    """A word as part of a pattern; of a very long one its hash, which tells it as well."""
    return word if len(word) <= LONG_WORD else "#" + hashlib.blake2b(word.encode(), digest_size=16).hexdigest()


class _Neighbours:
    """The words around places of a text, asked for from left to right.

    What is known of the last word that was looked at is kept, so a text without
    blanks is walked through once, however many places it has.
    """

    def __init__(self, text: str):
        self.text = text
        self.first = self.seen = -1
        self.before = self.after = ""
        self.low = self.high = -1

    def begin(self, at: int) -> int:
        """Where the word begins that ``at`` is in; ``before`` is the word before it."""
        text, start = self.text, at
        stop = max(self.seen, 0)
        while start > stop and not text[start - 1].isspace():
            start -= 1
        if start == stop == self.seen and start > self.first >= 0 and not text[start - 1].isspace():
            self.seen = max(at, self.seen)
            return self.first
        self.seen = at
        if start != self.first:
            self.first = start
            end = start
            while end > 0 and text[end - 1].isspace():
                end -= 1
            begin = end
            while begin > 0 and not text[begin - 1].isspace():
                begin -= 1
            self.before = _named(text[begin:end].lower())
        return start

    def following(self, at: int) -> str:
        """The word after that which ``at`` is in: what hangs on to an instance is no word of its own."""
        text, n = self.text, len(self.text)
        if self.low <= at <= self.high:
            return self.after
        start = at
        while start < n and not text[start].isspace():
            start += 1
        self.low, self.high = at, start
        while start < n and text[start].isspace():
            start += 1
        end = start
        while end < n and not text[end].isspace():
            end += 1
        self.after = _named(text[start:end].lower())
        return self.after


def slots(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Seeds and other words that look like identifiers, with their patterns."""
    words = {m.start(): m.end() for m in _NUMBER_WORD.finditer(text)} if _DIGIT.search(text) else {}
    if "=" in text or ":" in text:
        words.update((m.start(), m.end()) for m in _KEYED_WORD.finditer(text))
    found = [(a, b, True) for a, _, b in base]
    covered = sorted((a, b) for a, _, b in base)
    k = 0
    for start, end in sorted(words.items()):
        while k < len(covered) and covered[k][1] <= start:
            k += 1
        if any(a < end and b > start for a, b in covered[k : k + 4]):
            continue
        key = _KEY.match(text, start, end)
        start = key.end() if key else start
        core = text[start:end].strip(_EDGE)
        if len(core) >= LEAST_LENGTH and (key or _DIGIT.search(core)):
            start = text.index(core, start)
            found.append((start, start + len(core), False))
    out: list = [None] * len(found)
    near, word, key = _Neighbours(text), -1, None
    for k in sorted(range(len(found)), key=lambda k: found[k][:2]):
        start, end, seed = found[k]
        first = near.begin(start)
        # Each word is searched for its key once, however many seeds it has.
        if first != word:
            word, key = first, _KEY.match(text, first)
        # A seed is a value if all that is before it in its word is a key; other values
        # may be quoted.
        held = key and (start == key.end() if seed else start >= key.end())
        patterns = [("L", near.before), ("R", near.following(end))]
        if held:
            patterns.append(("K", _named(key.group(1).lower())))
        out[k] = {
            "start": start,
            "end": end,
            "seed": seed,
            "instance": _named(text[start:end].lower()),
            "patterns": [{"side": s, "word": w} for s, w in patterns if w],
        }
    return out


SPAN = "struct<start:int,kind:int,`end`:int>"
SLOT = "struct<start:int,`end`:int,seed:boolean,instance:string,patterns:array<struct<side:string,word:string>>>"


def marked(docs: DataFrame) -> DataFrame:
    """Add the base spans and the slots of every text, and drop the text."""
    schema = f"_doc bigint, _key bigint, base array<{SPAN}>, slots array<{SLOT}>"
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    pattern = pa.struct([("side", pa.string()), ("word", pa.string())])
    slot = pa.struct(
        [("start", pa.int32()), ("end", pa.int32()), ("seed", pa.bool_()), ("instance", pa.string()), ("patterns", pa.list_(pattern))]
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            base, own = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                found = base_spans(text)
                base.append([{"start": a, "kind": k, "end": b} for a, k, b in found])
                own.append(slots(text, found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_doc"), batch.column("_key"), pa.array(base, pa.list_(span)), pa.array(own, pa.list_(slot))],
                ["_doc", "_key", "base", "slots"],
            )

    return keyed(docs.select("doc_id", "text")).select("_doc", "_key", "text").mapInArrow(run, schema)


def pattern_totals(docs: DataFrame) -> DataFrame:
    """How often every word, and every key in ``key=value``, occurs in all texts."""

    def flushed(counts: Counter) -> pa.RecordBatch:
        keys = Counter()
        for word, n in counts.items():
            inside = _KEY.match(word)
            if inside and inside.end() < len(word):
                keys[_named(inside.group(1))] += n
        words = [*map(_named, counts), *keys]
        sides = ["W"] * len(counts) + ["K"] * len(keys)
        numbers = [*counts.values(), *keys.values()]
        counts.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(sides, pa.string()), pa.array(words, pa.string()), pa.array(numbers, pa.int64())], ["kind", "word", "total"]
        )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in parts:
            for text in batch.column("text"):
                with no_cycles():
                    counts.update((text.as_py() or "").lower().split())
                if len(counts) > MEMORY_WORDS:
                    yield flushed(counts)
        yield flushed(counts)

    rows = docs.select("text").mapInArrow(run, "kind string, word string, total bigint")
    return rows.groupBy("kind", "word").agg(F.sum("total").alias("total"))


def score_graph(edges: DataFrame, totals: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Iterated scores: patterns (side, word, score) and instances (instance, score).

    ``edges`` has (side, word, instance, n, seed).
    """
    kind = F.when(F.col("side") == "K", F.lit("K")).otherwise(F.lit("W"))
    patterns = edges.select("side", "word").distinct().withColumn("kind", kind)
    totals = stored(patterns.join(totals, ["kind", "word"]).select("side", "word", "total"), "pattern-totals")
    instances = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("score"))
    scores = None
    for _ in range(rounds):
        good = F.when(F.col("score") >= INSTANCE_SCORE, 1)
        scores = (
            edges.join(instances, "instance")
            .groupBy("side", "word")
            .agg(F.sum(F.col("n") * F.col("score")).alias("held"), F.count(good).alias("support"))
            .join(totals, ["side", "word"])
            .select(
                "side",
                "word",
                F.when(F.col("support") >= LEAST_INSTANCES, F.least(F.lit(1.0), F.col("held") / F.col("total")))
                .otherwise(0.0)
                .alias("pattern_score"),
            )
        )
        scores = stored(scores, "pattern-scores")
        miss = F.sum(F.log(1 - F.least(F.col("pattern_score"), F.lit(0.999))))
        instances = (
            edges.join(scores, ["side", "word"])
            .groupBy("instance")
            .agg(F.when(F.max("seed"), 1.0).otherwise(1 - F.exp(miss)).alias("score"))
        )
        instances = stored(instances, "instance-scores")
    return scores, instances


def find_personal_data(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Add ``spans``: array of (start, kind, end), kinds as numbers of ``KINDS``, in order."""
    rows = stored(marked(docs), "marked")
    slot = rows.select("_doc", "_key", F.explode("slots").alias("slot")).select("_doc", "_key", "slot.*")
    contexts = slot.select("_doc", "_key", "start", "end", "seed", "instance", F.explode("patterns").alias("p")).select(
        "*", "p.side", "p.word"
    ).drop("p")
    edges = contexts.groupBy("side", "word", "instance").agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed"))
    edges = stored(edges, "pattern-edges")
    patterns, instances = score_graph(edges, pattern_totals(docs), rounds)
    high = patterns.where(F.col("pattern_score") >= PATTERN_SCORE).select("side", "word")
    found = (
        contexts.where("not seed")
        .join(high, ["side", "word"], "left_semi")
        .join(instances.where(F.col("score") >= INSTANCE_SCORE), "instance", "left_semi")
        .groupBy("_doc", "_key")
        .agg(F.collect_set(F.struct("start", F.lit(KINDS.index("id")).alias("kind"), "end")).alias("found"))
    )
    base = rows.select("_doc", "_key", "base").dropDuplicates(["_doc", "_key"])
    spans = base.join(found, ["_doc", "_key"], "left").select(
        "_doc", "_key", F.array_sort(F.concat("base", F.coalesce("found", F.array().cast(f"array<{SPAN}>")))).alias("spans")
    )
    rows = keyed(packed(docs, ["doc_id", "text"], ["spans"])).join(spans, ["_doc", "_key"], "left")
    return unpacked(rows, kept_columns(docs, ["spans"]), {"spans": F.col("spans")})


def span_text(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ","
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and hash of the base spans of all documents, and all spans."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = find_personal_data(docs).drop("text")
    base = F.filter("spans", lambda s: s["kind"] < KINDS.index("id"))

    def number(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    return rows.select(
        "doc_id",
        *[number(k) for k in range(4)],
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )
