import pytest

from check import compare
from namelens.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_like_its_sql(spark, name):
    assert compare(spark, FOLDER, name).startswith("ok")


def test_oracles_are_sql():
    assert all(isinstance(text, str) for text in ORACLES.values())


@pytest.mark.parametrize("name", ["op1_lines", "op4_near_duplicates", "op5_toxicity", "op6_pii", "op8_mixing", "op9_fingerprints"])
def test_query_has_a_row_for_every_document(spark, name):
    rows = QUERIES[name](spark, FOLDER)
    found = [r.doc_id for r in rows.select("doc_id").collect()]
    docs = [r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()]
    assert sorted(found) == sorted(docs)
