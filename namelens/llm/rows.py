"""Whole rows carried beside the columns that an operator works on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW = "_row"
LAST_ID = (1 << 63) - 1


def kept_columns(docs: DataFrame, added: list[str] | tuple = ()) -> list[str]:
    """Columns that are passed on: all but those an added column replaces."""
    names = {a.lower() for a in added}
    return [c for c in docs.columns if c.lower() not in names]


def packed(docs: DataFrame, needed: list[str], added: list[str] | tuple = ()) -> DataFrame:
    """The ``needed`` columns, and all that are passed on in one struct ``_row``.

    So no column of the caller can meet one of the operator's by name.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in kept_columns(docs, added)])
    return docs.select(*[F.col(f"`{c}`").alias(c) for c in needed], row.alias(ROW))


def unpacked(rows: DataFrame, columns: list[str], added: dict[str, Column] | None = None) -> DataFrame:
    """The carried ``columns`` again, then the added ones."""
    return rows.select(
        *[F.col(ROW).getField(c).alias(c) for c in columns],
        *[c.alias(n) for n, c in (added or {}).items()],
    )


def row_field(docs: DataFrame, added: list[str] | tuple = ()) -> T.StructField:
    kept = set(kept_columns(docs, added))
    return T.StructField(ROW, T.StructType([f for f in docs.schema.fields if f.name in kept]))


def keyed(docs: DataFrame) -> DataFrame:
    """Rows with ``_doc``, an id that is never null, and ``_key``, which also tells texts apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns(
        {"_doc": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)), "_key": F.xxhash64("doc_id", text)}
    )


def texts_of(docs: DataFrame) -> DataFrame:
    """``_doc``, ``_key`` and the text of every row; a null text is an empty one."""
    return keyed(docs.select("doc_id", "text")).select("_doc", "_key", F.coalesce("text", F.lit("")).alias("text"))
