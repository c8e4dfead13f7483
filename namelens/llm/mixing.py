"""Mixing sources to target weights with a multivariate hypergeometric splitting tree.

Every source is a permutation of its documents by a seeded hash, cut into blocks
of about equal size. A source's target fixes how many whole passes over it the
mix makes and which leading part of the permutation it takes once more. The
exact block quotas of all sources are then split among the output shards: a
node of the tree draws how many blocks of each source go to its left half, from
the multivariate hypergeometric distribution, down to single shards. Each shard
gets disjoint runs of the permuted blocks and shuffles them by itself.

All of it is DataFrame code. The only tables without a row per document are
bounded: one row per source, and source x 2**14 hash ranges.

Documents with null or empty texts have size 0; they are taken once if the cut
reaches them, and add nothing. A null source is a source of its own, the last
one. Repeated rows share their place in the permutation, so they are taken
alike. An empty table gives an empty mix. Added columns replace columns of the
same name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from namelens.llm.rows import kept_columns, packed, unpacked
from namelens.operators.joins import keyed_join
from namelens.operators.snapshot import snapshot

WEIGHTS = (3, 1, 2)  # by the order of the sources, repeating
TOTAL_SHARE = 1.5  # words of the mix to words of the input
MOST_PASSES = 2  # no document is taken more often
BLOCK_WORDS = 65_536
SHARD_WORDS = 4_000_000
MOST_SHARDS = 4_096
SEED = 8

HASH_BITS = 60
RANGE_BITS = 14


def text_size(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def place_of(doc_id: Column, text: Column, seed: int) -> Column:
    """A 60-bit hash of the row: its place in the permutation of its source."""
    parts = F.concat_ws(
        "|",
        F.lit(str(seed)),
        F.coalesce(doc_id.cast("string"), F.lit("")),
        F.md5(F.coalesce(text, F.lit("")).cast("binary")),
    )
    return F.conv(F.substring(F.md5(parts.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def source_key(source: Column) -> Column:
    """A key without nulls, in which no name equals the null source."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("null"))


def targets(sizes: DataFrame, weights=WEIGHTS, share=TOTAL_SHARE, passes=MOST_PASSES) -> DataFrame:
    """One row per source with its target: shares by weight, held to ``passes`` times the size.

    What the full sources cannot take is shared again among the others by weight,
    so in the end all others stand at one level: target = level x weight. The
    sources are in code-point order, null last; there is one row for each.
    """
    one = sizes.groupBy("_key", "_source").agg(F.sum("_size").alias("source_size"))
    order = Window.orderBy(F.col("_source").asc_nulls_last())
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod(F.col("rank"), F.lit(len(weights))))
    one = one.withColumn("rank", F.row_number().over(order) - 1).withColumn("weight", weight)
    full = F.col("source_size") * passes
    by_fill = Window.orderBy(full / F.col("weight"), "rank")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    one = one.withColumn(
        "level",
        (F.sum("source_size").over(everything) * share - F.coalesce(F.sum(full).over(before), F.lit(0)))
        / F.sum("weight").over(rest),
    )
    fits = F.when(F.col("level") * F.col("weight") <= full, F.col("level"))
    # The first source that the level does not fill: its level holds for all after it.
    one = one.withColumn("level", F.min_by(fits, F.when(fits.isNotNull(), full / F.col("weight"))).over(everything))
    level_target = F.col("level") * F.col("weight")
    return one.select(
        "_key",
        "_source",
        "source_size",
        "rank",
        F.least(full.cast("double"), F.coalesce(level_target, full.cast("double"))).alias("target"),
    )


def cuts(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source: whole passes, the hash up to which rows are taken once more, one more row.

    The leading rows are summed up to the last that fits; the row of the best
    size behind them closes the gap. Sums are taken by hash range first, so only
    one range of each source is looked at row by row.
    """
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = sources.withColumn("passes", passes.cast("bigint")).withColumn(
        "rest", F.col("target") - F.col("passes") * F.col("source_size")
    )
    plan = snapshot(plan, "sources")
    units = sizes.groupBy("_key", "_place").agg(F.sum("_size").alias("_size"))
    units = snapshot(units.withColumn("_range", F.shiftright("_place", HASH_BITS - RANGE_BITS)), "units")
    running = Window.partitionBy("_key").orderBy("_range")
    ranges = units.groupBy("_key", "_range").agg(F.sum("_size").alias("_sum"))
    ranges = ranges.withColumn("_upto", F.sum("_sum").over(running))
    last = (
        keyed_join(ranges, plan.select("_key", "rest"), ["_key"], "inner", stored=True)
        .where("_upto > rest")
        .groupBy("_key", "rest")
        .agg(F.min("_range").alias("_range"), F.min_by(F.col("_upto") - F.col("_sum"), "_range").alias("_before"))
    )
    last = snapshot(last, "last-range")
    inside = Window.partitionBy("_key").orderBy("_place")
    leading = (
        keyed_join(units, last, ["_key", "_range"], "inner", stored=True)
        .withColumn("_upto", F.col("_before") + F.sum("_size").over(inside))
        .where("_upto <= rest")
        .groupBy("_key")
        .agg(F.max("_place").alias("_cut"), F.max("_upto").alias("_reached"))
    )
    first_of_range = F.shiftleft("_range", HASH_BITS - RANGE_BITS) - 1
    cut = last.join(leading, "_key", "left").select(
        "_key",
        F.coalesce("_cut", first_of_range).alias("cut"),
        (F.col("rest") - F.coalesce("_reached", "_before")).alias("gap"),
    )
    cut = snapshot(cut, "cuts")
    behind = keyed_join(units, cut, ["_key"], "inner", stored=True).where(
        (F.col("_place") > F.col("cut")) & (F.col("_size") > 0)
    )
    off = F.abs(F.col("_size") - F.col("gap"))
    best = behind.groupBy("_key").agg(F.min(off).alias("_best")).join(cut.select("_key", "gap"), "_key")
    best = snapshot(best.where("_best < gap").select("_key", "_best"), "best")
    extra = (
        keyed_join(behind, best, ["_key"], "inner", stored=True)
        .where(off == F.col("_best"))
        .groupBy("_key")
        .agg(F.min("_place").alias("extra"))
    )
    # A source whose rest is its whole size, or nothing, has no cut.
    return (
        plan.join(cut.select("_key", "cut"), "_key", "left")
        .join(extra, "_key", "left")
        .withColumn("cut", F.when(F.col("rest") <= 0, F.lit(-1)).otherwise(F.coalesce("cut", F.lit(2**HASH_BITS))))
        .withColumn("extra", F.coalesce("extra", F.lit(-1)))
    )


def with_blocks(plan: DataFrame, block_words: int) -> DataFrame:
    """Number of blocks of each source, and of block draws that the mix makes."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("bigint")
    plan = plan.withColumn("blocks", blocks)
    partial = F.when(F.col("cut") < 0, F.lit(0)).otherwise(
        F.least(F.col("blocks"), F.floor(F.col("cut") / 2.0**HASH_BITS * F.col("blocks")) + 1)
    )
    plan = plan.withColumn("partial", partial.cast("bigint"))
    extra = F.when(F.col("extra") >= 0, 1).otherwise(0)
    return plan.withColumn("draws", F.col("passes") * F.col("blocks") + F.col("partial") + extra)


def hypergeometric(good: str, total: str, drawn: str, u: str) -> str:
    """SQL for a hypergeometric draw by inversion: how many of ``good`` are among ``drawn``.

    The probabilities are summed by their recurrence over the whole support, or
    over 12 standard deviations and 12 steps to both sides where it is wider;
    beyond lies less than 1e-30.
    """
    mean = f"({drawn} * ({good} / double({total})))"
    deviation = (
        f"sqrt({mean} * (1 - {good} / double({total})) * ({total} - {drawn}) / greatest({total} - 1, 1))"
    )
    low = f"greatest(0, {drawn} - ({total} - {good}), bigint(floor({mean} - 12 * {deviation} - 12)))"
    high = f"least({good}, {drawn}, bigint(ceil({mean} + 12 * {deviation} + 12)))"
    ratio = (
        f"(double({good} - k) * ({drawn} - k) / ((k + 1.0d) * ({total} - {good} - {drawn} + k + 1)))"
    )
    weights = f"sequence({low}, {high})"
    whole = (
        f"aggregate({weights}, named_struct('w', 1.0d, 's', 0.0d), "
        f"(a, k) -> named_struct('w', a.w * {ratio}, 's', a.s + a.w), a -> a.s)"
    )
    return (
        f"case when {total} <= 0 or {drawn} <= 0 or {good} <= 0 then 0L "
        f"when {drawn} >= {total} then bigint({good}) else "
        f"least({high}, {low} + aggregate({weights}, "
        f"named_struct('w', 1.0d, 's', 0.0d, 'n', 0L, 'goal', {u} * {whole}), "
        f"(a, k) -> named_struct('w', a.w * {ratio}, 's', a.s + a.w, "
        f"'n', a.n + if(a.s + a.w < a.goal, 1L, 0L), 'goal', a.goal), a -> a.n)) end"
    )


def split_quotas(counts: DataFrame, shards: int, seed: int) -> DataFrame:
    """The splitting tree: ``counts`` (one row, array by source) to one row per shard."""
    total = "aggregate(counts, 0L, (a, x) -> a + x)"
    nodes = counts.select("counts", F.lit(0).alias("lo"), F.lit(shards).alias("hi")).withColumn(
        "all", F.expr(total)
    )
    bound = "(bigint({0}) * `all`) div {1}"
    u = f"(pmod(xxhash64({seed}, lo, hi, i), 9007199254740991) + 0.5d) / 9007199254740992d"
    draw = hypergeometric("acc.n", "acc.left", "acc.drawn", "acc.u")
    # Each source in turn: its draw is conditional on those before it.
    step = (
        "(acc0, i) -> transform(array(named_struct('n', counts[i], 'left', acc0.left, "
        f"'drawn', acc0.drawn, 'u', {u}, 'out', acc0.out)), acc -> transform(array({draw}), "
        "got -> named_struct('left', acc.left - acc.n, 'drawn', acc.drawn - got, "
        "'out', concat(acc.out, array(got))))[0])[0]"
    )
    for _ in range(max(0, (shards - 1).bit_length())):
        mid = "int((lo + hi) div 2)"
        wanted = f"({bound.format(mid, shards)} - {bound.format('lo', shards)})"
        start = f"named_struct('left', {total}, 'drawn', {wanted}, 'out', array_repeat(0L, 0))"
        go = f"aggregate(if(size(counts) = 0, array_repeat(0, 0), sequence(0, size(counts) - 1)), {start}, {step}, acc -> acc.out)"
        drawn = nodes.withColumn("got", F.expr(f"if(hi - lo > 1, {go}, counts)"))
        halves = F.expr(
            f"""explode(if(hi - lo > 1,
              array(named_struct('counts', got, 'lo', lo, 'hi', {mid}),
                    named_struct('counts', zip_with(counts, got, (a, b) -> a - b), 'lo', {mid}, 'hi', hi)),
              array(named_struct('counts', counts, 'lo', lo, 'hi', hi))))"""
        )
        nodes = drawn.select(halves.alias("node"), "all").select("node.*", "all")
    return nodes.select(F.col("lo").alias("shard"), "counts")


@dataclass
class Mix:
    """A planned mix: ``sources`` has a row per source with its quotas by shard."""

    sources: DataFrame
    shards: int


def plan_mix(
    sizes: DataFrame,
    *,
    weights=WEIGHTS,
    share: float = TOTAL_SHARE,
    passes: int = MOST_PASSES,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> Mix:
    """Plan from rows of (_key, _source, _size, _place)."""
    plan = snapshot(with_blocks(cuts(sizes, targets(sizes, weights, share, passes)), block_words), "mix")
    words = plan.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    shards = int(min(MOST_SHARDS, max(1, -(-words // shard_words))))
    in_order = F.array_sort(F.collect_list(F.struct("rank", "draws")))
    counts = plan.agg(in_order.alias("list")).select(F.col("list.draws").alias("counts"))
    quotas = split_quotas(counts, shards, seed).select("shard", F.posexplode("counts").alias("rank", "quota"))
    by_shard = Window.partitionBy("rank").orderBy("shard")
    upto = quotas.withColumn("end", F.sum("quota").over(by_shard))
    ends = upto.groupBy("rank").agg(F.array_sort(F.collect_list(F.struct("shard", "end"))).alias("list"))
    ends = ends.select("rank", F.col("list.end").alias("ends"))
    return Mix(snapshot(plan.join(ends, "rank"), "mix-plan"), shards)


def with_copies(rows: DataFrame, mix: Mix) -> DataFrame:
    """Add target, source_size and the shard of every copy that the mix takes of a row."""
    table = mix.sources.drop("_source", "rank", "rest")
    rows = keyed_join(rows, table, ["_key"], "left", stored=True)
    block = F.least(
        F.col("blocks") - 1, F.floor(F.col("_place") / 2.0**HASH_BITS * F.col("blocks"))
    ).cast("bigint")
    whole = F.when(
        F.col("passes") > 0,
        F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("passes") - 1), lambda e: e * F.col("blocks") + block),
    ).otherwise(F.array().cast("array<bigint>"))
    once = F.when(F.col("_place") <= F.col("cut"), F.array(F.col("passes") * F.col("blocks") + block)).when(
        F.col("_place") == F.col("extra"), F.array(F.col("draws") - 1)
    )
    draws = F.concat(whole, F.coalesce(once, F.array().cast("array<bigint>")))
    shard_of = lambda j: F.size(F.filter("ends", lambda end: end <= j))
    return rows.withColumn("_shards", F.transform(draws, shard_of)).drop(
        "blocks", "partial", "draws", "passes", "cut", "extra", "ends"
    )


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    return docs.withColumns(
        {
            "_key": source_key(F.col("source")),
            "_source": F.col("source"),
            "_size": text_size(F.col("text")),
            "_place": place_of(F.col("doc_id"), F.col("text"), seed),
        }
    )


def mix_documents(docs: DataFrame, seed: int = SEED, **settings) -> DataFrame:
    """The mixed documents: each as often as taken, dealt to shards and shuffled there.

    Columns are those of ``docs`` and ``shard``. A shard is one partition, sorted
    by a hash of document and copy.
    """
    rows = sized(packed(docs, ["doc_id", "text", "source"], ["shard"]), seed)
    sizes = snapshot(rows.select("_key", "_source", "_size", "_place"), "sizes")
    mix = plan_mix(sizes, seed=seed, **settings)
    copies = with_copies(rows.drop("text"), mix).select("_row", "_place", F.posexplode("_shards").alias("_copy", "shard"))
    order = F.xxhash64(F.lit(seed), "_place", "_copy")
    dealt = copies.withColumn("_order", order).repartition(mix.shards, "shard")
    dealt = dealt.sortWithinPartitions("shard", "_order", "_place")
    return unpacked(dealt, kept_columns(docs, ["shard"]), {"shard": F.col("shard")})


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, target of the source and words taken of all documents, and the shards of the copies."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    rows = snapshot(sized(docs).drop("text", "source"), "sizes")
    taken = with_copies(rows, plan_mix(rows))
    return taken.select(
        "doc_id",
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("_size") * F.size("_shards")).cast("bigint").alias("taken"),
        F.array_join(F.transform("_shards", lambda s: s.cast("string")), ",").alias("shards"),
    )
