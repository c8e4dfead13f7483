"""The derived tables as a chain: what each is made from, and how to bring it up to date.

Stored derived tables know what they were made from: for each batch the write that
held its source rows and the versions of the lookups. What differs from that is
made anew, batch by batch; a batch whose source is gone goes from all tables down
the chain. No row is read to find out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from namelens import schemas
from namelens.plans import lookups
from namelens.plans.baseline import BATCH_KEYS, age_baseline, gender_baseline, person_clean
from namelens.plans.enrichment import of_batches
from namelens.sources.parts import MADE_FROM, WRITE, local_rows
from namelens.sources.tables import PER_BATCH, Tables


@dataclass(frozen=True)
class View:
    """A derived table: the tables it reads and the function that makes it from them."""

    needs: tuple[str, ...]
    make: Callable[..., DataFrame]
    # Whether it is a join with a stored lookup.
    joins: bool = False
    # A projection that is cheaper to make than to store; what needs it is made from its source.
    passed_on: bool = False


VIEWS: dict[str, View] = {
    "name_count_stage": View(("name_counts",), lookups.name_count_stage),
    "voter_stage": View(("voter_roll",), lookups.voter_stage),
    "gender_lookup": View(("name_count_stage",), lookups.gender_lookup),
    "voter_gender_lookup": View(("voter_stage",), lookups.voter_gender_lookup),
    "age_lookup_generic": View(
        ("name_count_stage",), lambda s: lookups.age_lookup(s, lookups.GENERIC_AGES)
    ),
    "age_lookup_specific": View(
        ("name_count_stage",), lambda s: lookups.age_lookup(s, lookups.SPECIFIC_AGES)
    ),
    "person_clean": View(("person_input",), person_clean, passed_on=True),
    "gender_baseline": View(("person_clean", "gender_lookup"), gender_baseline, joins=True),
    "age_baseline_expanded": View(("person_clean", "age_lookup_specific"), age_baseline, joins=True),
    "age_baseline_collapsed": View(("person_clean", "age_lookup_generic"), age_baseline, joins=True),
}


def refresh(
    name: str, sources: dict[str, DataFrame], batches: DataFrame | None = None
) -> DataFrame:
    """The up-to-date rows of a derived table.

    ``sources`` holds base tables and any derived tables that are already
    stored; what is missing is made first. With ``batches`` only the people of
    those batches are worked on, for a rewrite of just their partitions. Rows
    deleted at the source are gone from the result.
    """
    if name in sources:
        rows = sources[name]
        if name == "person_input" and batches is not None:
            return of_batches(rows, batches)
        return rows
    view = VIEWS[name]
    return view.make(*[refresh(need, sources, batches) for need in view.needs])


class Chain:
    """The derived tables as they are stored."""

    def __init__(self, tables: Tables):
        self.tables = tables

    def refresh(self, name: str, batches: DataFrame | None = None) -> None:
        """Bring a stored derived table up to date, and those it needs before it.

        With ``batches`` only those batches are looked at. What is up to date is
        not written again.
        """
        for need in VIEWS[name].needs:
            if need in VIEWS and not VIEWS[need].passed_on:
                self.refresh(need, batches)
        if name in PER_BATCH:
            self._refresh_batches(name, batches)
        else:
            self._refresh_whole(name)

    def _source(self, name: str) -> str:
        """The stored table that the people of a derived one come from."""
        source = VIEWS[name].needs[0]
        return self._source(source) if source in VIEWS and VIEWS[source].passed_on else source

    def _made(self, name: str, people: DataFrame) -> DataFrame:
        """The rows of a derived table for the people of its source."""
        source, *others = VIEWS[name].needs
        if source in VIEWS and VIEWS[source].passed_on:
            people = self._made(source, people)
        inputs = [people, *[self.tables.read(n) for n in others]]
        return VIEWS[name].make(*inputs, stored=True) if VIEWS[name].joins else VIEWS[name].make(*inputs)

    def _versions(self, names: tuple[str, ...]) -> str:
        return "/".join(f"{n}-{self.tables.version(n)}" for n in names)

    def _refresh_whole(self, name: str) -> None:
        t, view = self.tables, VIEWS[name]
        state = self._versions(view.needs)
        noted = t.read("derived_from")
        if t.has(name):
            # Loaded by other means, or made from the same versions.
            if not all(t.has(n) for n in view.needs) or not noted.where((F.col("name") == name) & (F.col("made_from") == state)).isEmpty():
                return
        t.replace(name, view.make(*[t.read(n) for n in view.needs]))
        new = t.spark.createDataFrame([(name, state)], schemas.DERIVED_FROM)
        t.replace("derived_from", noted.where(F.col("name") != name).unionByName(new))

    def _refresh_batches(self, name: str, batches: DataFrame | None) -> None:
        t = self.tables
        source, stored = t.people(self._source(name)), t.people(name)
        state = F.concat(F.col(WRITE), F.lit("/" + self._versions(VIEWS[name].needs[1:])))
        wanted = source.pointer().select(*BATCH_KEYS, state.alias("_wanted"))
        have = stored.pointer().select(*BATCH_KEYS, MADE_FROM)
        if batches is not None:
            keys = batches.select(*BATCH_KEYS).distinct()
            wanted, have = (df.join(F.broadcast(keys), BATCH_KEYS, "left_semi") for df in (wanted, have))
        differs = ~F.col("_wanted").eqNullSafe(F.col(MADE_FROM))
        # One row a batch that is to be read or dropped.
        changed = wanted.join(have, BATCH_KEYS, "full_outer").where(differs).select(*BATCH_KEYS, "_wanted").collect()
        schema = T.StructType([*stored.keys.fields, T.StructField(MADE_FROM, T.StringType())])
        stale = local_rows(t.spark, [tuple(r) for r in changed if r["_wanted"] is not None], schema)
        gone = local_rows(t.spark, [tuple(r)[:2] for r in changed if r["_wanted"] is None], stored.keys)
        if any(r["_wanted"] is not None for r in changed):
            stored.replace(self._made(name, source.read(stale)), made_from=stale)
        if any(r["_wanted"] is None for r in changed):
            stored.drop(gone)

    def drop(self, batches: DataFrame) -> None:
        """Take batches out of the people and of every table made from them."""
        self.tables.drop_batches("person_input", batches)
        for name in VIEWS:
            if name in PER_BATCH:
                self.tables.drop_batches(name, batches)
