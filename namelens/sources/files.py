"""Reading client uploads, voter rolls and name counts from delimited files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from namelens import schemas
from namelens.functions import DATE_FORMATS, try_date, try_number


def read_client_csv(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    quote: str = '"',
    glob: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Client files by position, with their path and place in it.

    The first line is skipped whatever it says. ``_block`` is for
    ``with_file_row_numbers``. ``quote=""`` keeps quote signs. ``max_files`` bounds
    what one run of a stream takes.
    """
    reader = spark.readStream if stream else spark.read
    reader = (
        reader.schema(schemas.struct(schemas.CLIENT_FILE))
        .option("header", True)
        .option("enforceSchema", True)
        .option("quote", quote)
        .option("recursiveFileLookup", True)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.csv(path).select(
        "*",
        F.col("_metadata.file_path").alias("storage_file_name"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def with_file_row_numbers(rows: DataFrame) -> DataFrame:
    """Number the rows of each file 1, 2, 3, … in file order.

    Spark reads a large file in blocks, each by one task and in order. So a row
    number is the row's place in its block plus the rows of the blocks before,
    and no file has to fit into one task. ``rows`` must come straight from the
    reader, without a shuffle in between.
    """
    placed = rows.withColumn("_place", F.monotonically_increasing_id())
    blocks = placed.groupBy("storage_file_name", "_block").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # One row per block of a file.
    earlier = (
        Window.partitionBy("storage_file_name")
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = blocks.select(
        "storage_file_name",
        "_block",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    return (
        placed.join(offsets, ["storage_file_name", "_block"])
        .withColumn("file_record_row_number", F.col("_place") + F.col("_shift") + 1)
        .drop("_block", "_place", "_shift")
    )


def to_landing(rows: DataFrame, load_ts: Column) -> DataFrame:
    """Client file rows in the columns of the landing table.

    A record id may not be missing: a row without one gets an id made from its
    file and row number, the same on every run.
    """
    numbered = with_file_row_numbers(rows).withColumn("record_id", F.nullif(F.trim("record_id"), F.lit("")))
    return fill_record_ids(numbered, "storage_file_name", "file_record_row_number").select(
        "record_id",
        "first_name",
        "last_name",
        "zip",
        "storage_file_name",
        "file_record_row_number",
        load_ts.alias("load_ts"),
    )


def read_batch_file(
    spark: SparkSession,
    path: str,
    client_id: int,
    batch_id: int,
    load_ts: Column,
    glob: str | None = None,
) -> DataFrame:
    """A client file loaded by hand under a given client and batch; no row is without an id."""
    return to_landing(read_client_csv(spark, path, glob=glob), load_ts).select(
        F.lit(client_id).cast("bigint").alias("client_id"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        "record_id",
        "first_name",
        "last_name",
        "zip",
        "load_ts",
    )


def safe_cast(rows: DataFrame, types: dict[str, str], formats=DATE_FORMATS) -> DataFrame:
    """Text columns in their declared types; a value that does not fit becomes null."""
    makers = {"string": lambda name, kind: F.col(name), "date": lambda name, kind: try_date(name, formats)}
    return rows.select(
        *[
            makers.get(kind, lambda n, k: try_number(n, k))(name, kind).alias(name)
            for name, kind in types.items()
        ]
    )


MALFORMED = "_malformed"


def load_voter_file(
    spark: SparkSession, path: str, loaded_ts: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """A voter roll (``|`` separated, Latin-1, read by position) and the lines that are none.

    The roll has the 33 fields in their types, bad values null. Lines with more or
    fewer fields are not loaded; they come as (storage_file_name, line).
    """
    texts = ", ".join(f"{name} string" for name in [*schemas.VOTER_FIELDS, MALFORMED])
    rows = (
        spark.read.schema(schemas.struct(texts))
        .option("sep", "|")
        .option("encoding", "ISO-8859-1")
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .csv(path)
    )
    stamp = F.current_timestamp() if loaded_ts is None else loaded_ts
    loaded = safe_cast(rows.where(F.col(MALFORMED).isNull()), schemas.VOTER_FIELDS)
    # The reader tells malformed lines only where it reads all fields: this asks for them, and is always true.
    whole = F.length(F.concat_ws("|", *schemas.VOTER_FIELDS)) >= 0
    rejected = rows.where(F.col(MALFORMED).isNotNull() & whole)
    return (
        loaded.withColumn("loaded_ts", stamp.cast("timestamp_ntz")),
        rejected.select(F.col("_metadata.file_path").alias("storage_file_name"), F.col(MALFORMED).alias("line")),
    )


def read_voter_file(spark: SparkSession, path: str, loaded_ts: Column | None = None) -> DataFrame:
    """A voter roll without its malformed lines."""
    return load_voter_file(spark, path, loaded_ts)[0]


def read_name_counts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Birth counts per name, gender and year, from one path or several."""
    return (
        spark.read.schema(schemas.struct(schemas.NAME_COUNTS))
        .option("header", True)
        .option("enforceSchema", True)
        .csv(path)
    )


def list_files(spark: SparkSession, path: str, pattern: str = ".*") -> DataFrame:
    """The files below a folder whose path fits a pattern; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", "modificationTime")
        .where(F.col("path").rlike(pattern))
    )


def fill_record_ids(rows: DataFrame, *place: str) -> DataFrame:
    """Give rows without an id one that is the same on every run.

    It is made from the row's place (file and row number), so repeating a load
    after a failure yields the same ids.
    """
    made = F.sha2(F.concat_ws("|", *place), 256)
    return rows.withColumn("record_id", F.coalesce("record_id", made))


def sample_client_file(voters: DataFrame, n: int) -> DataFrame:
    """A test upload: the first ``n`` voters by id, in the columns of a client file."""
    return (
        voters.orderBy("state_voter_id")
        .limit(n)
        .select(
            F.col("state_voter_id").cast("string").alias("record_id"),
            "first_name",
            "last_name",
            F.col("registration_zip_code").alias("zip"),
        )
    )
