"""URL filters: host and path rules over a Bloom filter cascade.

A cascade holds a list of keys exactly, relative to a known universe of keys.
Level 1 is a Bloom filter of the listed keys. The unlisted keys of the universe
that pass it by mistake are encoded in level 2, the listed keys that pass level
2 by mistake in level 3, and so on until a level makes no mistake. The first
level a key does not pass tells its side. Rows are judged by expressions over
the filters; the list itself is never joined.

Everything here is DataFrame code. Filters are cut into shards by the hash of
the key, so that no task builds or holds more than a shard.

Null and empty keys are unlisted. An empty list gives a cascade without levels,
that lists nothing. Repeated keys count once. Keys outside the universe can be
judged listed by mistake, with the probability of a Bloom filter.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from namelens.llm.rows import kept_columns, packed, unpacked
from namelens.operators.snapshot import snapshot

# Listed keys of one shard, about.
SHARD_KEYS = 100_000
# Bits for each key and bits set by each key: level 1, and the levels after it.
FIRST_LEVEL = (10, 5)
LATER_LEVELS = (6, 4)
# Filters up to this size are a constant of the query; larger ones are looked up
# by shard in a shuffle.
CONSTANT_BYTES = 32 * 1024 * 1024


@dataclass
class Level:
    """One filter: ``table`` has an array of 64-bit ``words`` for each ``shard``."""

    table: DataFrame
    words: int
    probes: int


@dataclass
class Cascade:
    levels: list[Level]
    shards: int


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("shard")), F.lit(shards)).cast("int")


def bit_places(key: Column, number: int, words: int, probes: int) -> list[Column]:
    """The bits that ``key`` sets in level ``number``."""
    return [
        F.pmod(F.xxhash64(key, F.lit(number), F.lit(k)), F.lit(words * 64)) for k in range(probes)
    ]


def bit_of(place: Column) -> Column:
    """The bit of a place within its 64-bit word."""
    return F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)).cast("int")
    )


def passes(words: Column, key: Column, number: int, level: Level) -> Column:
    """Whether all bits of ``key`` are set in the words of its shard."""
    found = F.lit(True)
    for place in bit_places(key, number, level.words, level.probes):
        word = F.get(words, F.shiftright(place, 6).cast("int"))
        found = found & (word.bitwiseAND(bit_of(place)) != 0)
    return F.coalesce(found, F.lit(False))


def filter_of(keys: DataFrame, number: int, bits: int, probes: int, shards: int) -> Level:
    """The Bloom filter of the ``key`` column of distinct keys, by shard."""
    spark = keys.sparkSession
    most = (
        keys.groupBy(shard_of(F.col("key"), shards).alias("shard"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.max("n"))
        .first()[0]
    )
    words = max(1, -(-most * bits // 64))
    places = F.explode(F.array(*bit_places(F.col("key"), number, words, probes)))
    set_words = (
        keys.select(shard_of(F.col("key"), shards).alias("shard"), places.alias("place"))
        .groupBy("shard", F.shiftright("place", 6).cast("int").alias("word"))
        .agg(F.bit_or(bit_of(F.col("place"))).alias("bits"))
    )
    every = spark.range(shards).select(
        F.col("id").cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(words - 1))).alias("word"),
        F.lit(0).cast("bigint").alias("bits"),
    )
    table = (
        set_words.union(every)
        .groupBy("shard", "word")
        .agg(F.bit_or("bits").alias("bits"))
        .groupBy("shard")
        .agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("list"))
        .select("shard", F.col("list.bits").alias("words"))
    )
    return Level(snapshot(table, "bloom"), words, probes)


def with_words(rows: DataFrame, key: str, cascade: Cascade, use: Sequence[int]) -> tuple[DataFrame, list]:
    """Make the words of the levels in ``use`` reachable for each row's key."""
    size = sum(cascade.levels[i].words * 8 * cascade.shards for i in use)
    shard = shard_of(F.col(f"`{key}`"), cascade.shards)
    if size <= CONSTANT_BYTES:
        constants = []
        for i in use:
            by_shard = F.array_sort(F.collect_list(F.struct("shard", "words")))
            one = cascade.levels[i].table.agg(by_shard.alias("list")).select("list.words")
            constants.append(F.get(one.scalar(), shard))
        return rows, constants
    rows = rows.withColumn("_shard", shard)
    names = []
    for i in use:
        table = cascade.levels[i].table.select(
            F.col("shard").alias("_shard"), F.col("words").alias(f"_words{i}")
        )
        rows, names = rows.join(table, "_shard", "left"), [*names, F.col(f"_words{i}")]
    return rows, names


def build_cascade(universe: DataFrame, shard_keys: int = SHARD_KEYS) -> Cascade:
    """A cascade from distinct keys: ``universe`` has ``key`` and ``listed``.

    Each level reads only the keys that the one two levels before could not
    settle, so the sets shrink by the rate of mistakes of a filter.
    """
    universe = snapshot(
        universe.where(F.col("key").isNotNull() & (F.col("key") != ""))
        .groupBy("key")
        .agg(F.max("listed").alias("listed")),
        "keys",
    )
    listed = universe.where("listed").select("key")
    unlisted = universe.where("not listed").select("key")
    count = listed.count()
    cascade = Cascade([], max(1, -(-count // shard_keys)))
    encoded, other = listed, unlisted
    while count:
        number = len(cascade.levels)
        bits, probes = LATER_LEVELS if number else FIRST_LEVEL
        level = filter_of(encoded, number, bits, probes, cascade.shards)
        cascade.levels.append(level)
        rows, (words,) = with_words(other, "key", cascade, [number])
        mistaken = snapshot(
            rows.where(passes(words, F.col("key"), number, level)).select("key"), "mistaken"
        )
        count = mistaken.count()
        encoded, other = mistaken, encoded
    return cascade


def is_listed(rows: DataFrame, key: str, cascade: Cascade) -> tuple[DataFrame, Column]:
    """Rows and the column that tells whether their ``key`` is listed."""
    use = range(len(cascade.levels))
    rows, words = with_words(rows, key, cascade, use)
    k = F.col(f"`{key}`")
    answer = F.lit(len(cascade.levels) % 2 == 1)
    for i in reversed(use):
        answer = F.when(~passes(words[i], k, i, cascade.levels[i]), F.lit(i % 2 == 1)).otherwise(answer)
    return rows, F.when(k.isNull() | (k == ""), F.lit(False)).otherwise(answer)


def url_host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?`` or ``#``; A-Z lower-cased."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule (verdict, host, path) that fits, and its verdict; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    list_of: Callable[[DataFrame], DataFrame],
    url: str = "url",
) -> DataFrame:
    """Add host, path, rule and verdict to ``pages``.

    ``list_of`` gets the distinct url keys (host and path) of the corpus, with
    ``host`` and ``path``, and adds the boolean ``listed``. Added columns replace
    columns of the same name. Pages without a usable url have an empty host and
    path, and no rule or list blocks them.
    """
    names = ["host", "path", "rule", "verdict"]
    pages, kept = packed(pages, [url], names), kept_columns(pages, names)
    u = F.col(f"`{url}`")
    keyed = pages.withColumn("_host", F.coalesce(url_host(u), F.lit(""))).withColumn(
        "_path", F.coalesce(url_path(u), F.lit(""))
    )
    keyed = keyed.withColumn("_key", F.concat("_host", "_path"))
    keys = keyed.select(
        F.col("_key").alias("key"), F.col("_host").alias("host"), F.col("_path").alias("path")
    ).distinct()
    cascade = build_cascade(list_of(keys).select("key", "listed"))
    rows, listed = is_listed(keyed, "_key", cascade)
    rule, verdict = fitting_rule(F.col("_host"), F.col("_path"), rules)
    added = {
        "host": F.col("_host"),
        "path": F.col("_path"),
        "rule": rule,
        "verdict": F.coalesce(verdict, F.when(listed, F.lit("block")).otherwise(F.lit("allow"))),
    }
    return unpacked(rows, kept, added)


# The rules of the query.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
# Host labels of unwanted sites; the list has every url key of the corpus under them.
UNWANTED_LABELS = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]


def unwanted(keys: DataFrame) -> DataFrame:
    return keys.withColumn("listed", F.arrays_overlap(F.split("host", r"\."), F.array(*map(F.lit, UNWANTED_LABELS))))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of all pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, RULES, unwanted).select("page_id", "host", "path", "rule", "verdict")


def op10_sql() -> str:
    """The same verdicts, with the list as a predicate on the host."""
    labels = ", ".join(f"'{x}'" for x in UNWANTED_LABELS)
    cases = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [
        (f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')", h + p, v)
        for v, h, p in cases
    ]
    rule = " ".join(f"when {c} then '{name}'" for c, name, _ in fits)
    verdict = " ".join(f"when {c} then '{v}'" for c, _, v in fits)
    return f"""
with rest as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as r
  from pages
), parts as (
  select page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path
  from rest
)
select page_id, host, path, case {rule} end as rule,
  case {verdict} when list_has_any(string_split(host, '.'), [{labels}]) then 'block' else 'allow' end as verdict
from parts"""
