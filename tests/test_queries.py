"""Every registered query against its SQL, over all rows of the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from check import compare
from namelens import oracle, registry

FOLDER = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    assert set(registry.QUERIES) == set(oracle.ORACLES)
    assert set(registry.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["ssa_confidence_level", "record_count"]


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, name):
    assert compare(spark, FOLDER, name).startswith("ok")
