"""A training corpus from raw documents: five stages, each on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes each stage's rows to
the shared folder and reads them back for the next, so a lost executor or a
restart repeats one stage at most. All stages take nulls in any column, empty
and very long texts, repeated rows and empty tables, as their operators say.
Columns beside those of ``documents`` are passed on unchanged, whatever their names;
a caller's column named as one that the last stage adds is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namelens.llm.bpe import default_tokenizer, encode
from namelens.llm.lines import dedup_lines
from namelens.llm.mixing import mix_documents
from namelens.llm.near_duplicates import drop_near_duplicates
from namelens.llm.stored import stored, workers_find_package
from namelens.llm.toxicity import score

TOXIC_SCORE = 0.5
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def set_apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The columns of ``documents`` as they are and all others under names no operator uses, with their own."""
    names = {c: c if c in DOCUMENT else f"caller_{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), {n: c for c, n in names.items()}


def own_names(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """The caller's columns alone, under their own names."""
    return rows.select(*[F.col(n).alias(c) for n, c in names.items()])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    workers_find_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs, names = set_apart(docs)
    return own_names(score(docs, labels).where(F.col("toxic_score") < TOXIC_SCORE), names)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines; those that lose all they had go.

    ``n_chars`` is that of the new text. A document that was blank before stays.
    """
    workers_find_package(spark)
    docs, names = set_apart(docs)
    rows = dedup_lines(docs)
    left = F.coalesce(F.col("kept_text").rlike(r"\S"), F.lit(False))
    changed = F.col("n_removed") > 0
    rows = rows.where(~changed | left)
    new = {
        "text": F.col("kept_text"),
        "n_chars": F.when(changed, F.length("kept_text").cast("bigint")).otherwise(F.col("n_chars")),
    }
    return own_names(rows.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns]), names)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    workers_find_package(spark)
    docs, names = set_apart(docs)
    return own_names(drop_near_duplicates(docs), names)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, in shuffled shards."""
    workers_find_package(spark)
    docs, names = set_apart(docs)
    return own_names(mix_documents(docs), names)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and a check that they decode to it."""
    workers_find_package(spark)
    docs, names = set_apart(docs)
    rows = encode(docs, default_tokenizer(), decoded="decoded")
    return rows.select(
        *[F.col(n).alias(c) for n, c in names.items() if c.lower() not in ("n_tokens", "ids", "round_trip")],
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_copies),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

# Log-likelihoods, sketches and the tokenizer cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
