"""Keyed writes as pure functions: target rows and source rows in, new target rows out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from namelens.operators.joins import any_null, keyed_join

Literals = Mapping[str, Column]


def _key_match(keys: Sequence[str], null_safe: bool) -> Column:
    pairs = [(F.col(f"t.{k}"), F.col(f"s.{k}")) for k in keys]
    tests = [t.eqNullSafe(s) if null_safe else t == s for t, s in pairs]
    return reduce(lambda a, b: a & b, tests)


def one_row_per_key(source: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """``source`` with a ``_found`` mark that fails the job on a repeated key.

    The numbering needs the rows partitioned and sorted by key, as the join that
    follows does, so it adds neither a shuffle nor a sort. It stops at the second
    row of a key and never holds a group in memory.
    """
    message = F.concat(F.lit("upsert source has several rows for key "), F.to_json(F.struct(*keys)))
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(keys[0]))
    repeated = (nth > 1) if null_safe else (nth > 1) & ~any_null(keys)
    found = F.when(repeated, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return source.withColumn("_found", found)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    update_cols: Sequence[str] | None = None,
    set_literals: Literals | None = None,
    insert_literals: Literals | None = None,
    insert: bool = True,
    update: bool = True,
    target_pred: Column | None = None,
    null_safe: bool = False,
    null_keys: bool = True,
) -> DataFrame:
    """Merge ``source`` into ``target`` on ``keys``.

    Matched rows take ``update_cols`` (default: every source column that is not
    a key) and ``set_literals``; unmatched source rows are added with
    ``insert_literals``; columns the source lacks are null there. With
    ``target_pred`` only the target rows that satisfy it can match. A repeated
    source key fails the job. A null key matches nothing unless ``null_safe``.

    With ``null_keys`` the rows without a key go around the join, for which both
    sides are read once more. ``False`` is for keys declared not null; the result
    is the same.
    """
    keys = list(keys)
    set_literals = dict(set_literals or {})
    insert_literals = dict(insert_literals or {})
    columns = target.columns
    if update_cols is None:
        update_cols = [c for c in source.columns if c in columns and c not in keys]

    # Rows that cannot match go around the join: a null key is no join key, and a
    # shuffle on it would put all such rows into one task.
    split = null_keys and not null_safe
    aside = any_null(keys) if split else None
    if target_pred is not None:
        shut = ~F.coalesce(target_pred, F.lit(False))
        aside = shut if aside is None else aside | shut
    kept_aside = None if aside is None else target.where(aside)
    loose = source.where(any_null(keys)) if insert and split else None
    t = target if aside is None else target.where(~aside)
    t = t.withColumn("_kept", F.lit(True))
    s = one_row_per_key(source.where(~any_null(keys)) if split else source, keys, null_safe)
    match = _key_match(keys, null_safe)
    joined = t.alias("t").join(s.alias("s"), match, "full_outer" if insert else "left")

    kept, found = F.col("t._kept"), F.col("s._found")
    out = []
    for c in columns:
        old = F.col(f"t.{c}")
        new = F.col(f"s.{c}") if c in source.columns else F.lit(None)
        kind = target.schema[c].dataType
        if not update:
            matched = old
        elif c in set_literals:
            matched = set_literals[c].cast(kind)
        elif c in update_cols:
            matched = new.cast(kind)
        else:
            matched = old
        added = insert_literals.get(c, new).cast(kind)
        value = F.when(kept & found, matched).when(kept, old).otherwise(added)
        out.append(value.alias(c))
    result = joined.select(*out)
    if loose is not None:
        result = result.unionByName(_as_rows(loose, target, insert_literals))
    if kept_aside is not None:
        result = result.unionByName(kept_aside)
    return result


def _as_rows(source: DataFrame, target: DataFrame, literals: Literals) -> DataFrame:
    """``source`` in the columns and types of ``target``."""
    cols = []
    for field in target.schema.fields:
        own = F.col(field.name) if field.name in source.columns else F.lit(None)
        cols.append(literals.get(field.name, own).cast(field.dataType).alias(field.name))
    return source.select(*cols)


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source rows whose key is not in ``target`` yet; append them."""
    return source.join(target.select(*keys), list(keys), "left_anti").select(*source.columns)


def add_absent(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    insert_literals: Literals | None = None,
    null_keys: bool = True,
) -> DataFrame:
    """``target`` plus the source rows whose key it lacks; matched rows stay as they are."""
    return upsert(
        target,
        source,
        keys,
        update=False,
        insert_literals=insert_literals,
        null_keys=null_keys,
    )


def delete_matching(target: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` without the rows whose key is in ``keys_df``, however many rows a key has."""
    return keyed_join(target, keys_df, keys, "left_anti")


def update_matching(
    target: DataFrame,
    keys_df: DataFrame,
    keys: Sequence[str],
    sets: Literals,
    guard: Column | None = None,
) -> DataFrame:
    """Set columns on the target rows whose key is in ``keys_df`` and that pass ``guard``.

    ``sets`` may use the row's own columns, e.g. to keep a first start time.
    """
    marks = keys_df.select(*keys).distinct().withColumn("_hit", F.lit(True))
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    if guard is not None:
        hit = hit & F.coalesce(guard, F.lit(False))
    joined = target.join(marks, list(keys), "left")
    out = []
    for field in target.schema.fields:
        own = F.col(field.name)
        if field.name in sets:
            own = F.when(hit, sets[field.name].cast(field.dataType)).otherwise(own)
        out.append(own.alias(field.name))
    return joined.select(*out)
