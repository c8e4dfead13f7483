"""The queries of this package and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from namelens.llm.bpe import op7_bpe
from namelens.llm.fingerprints import op9_fingerprints
from namelens.llm.language_model import op12_language_model
from namelens.llm.lines import op1_lines
from namelens.llm.mixing import op8_mixing
from namelens.llm.near_duplicates import op4_near_duplicates
from namelens.llm.phrases import op11_phrases, op11_sql
from namelens.llm.pii import op6_pii
from namelens.llm.search import op2_search, op2_sql
from namelens.llm.stored import workers_find_package
from namelens.llm.substrings import op3_substrings, op3_sql
from namelens.llm.toxicity import op5_toxicity
from namelens.llm.urls import op10_sql, op10_url_filters
from namelens.llm.whitening import op13_whitening

Query = Callable[[SparkSession, str], DataFrame]


def runnable(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_find_package(spark)
        return query(spark, sf_dir)

    return run


OPERATORS: dict[str, Query] = {
    "op1_lines": op1_lines,
    "op2_search": op2_search,
    "op3_substrings": op3_substrings,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_toxicity": op5_toxicity,
    "op6_pii": op6_pii,
    "op7_bpe": op7_bpe,
    "op8_mixing": op8_mixing,
    "op9_fingerprints": op9_fingerprints,
    "op10_url_filters": op10_url_filters,
    "op11_phrases": op11_phrases,
    "op12_language_model": op12_language_model,
    "op13_whitening": op13_whitening,
}

QUERIES: dict[str, Query] = {name: runnable(query) for name, query in OPERATORS.items()}

# The others rest on hashes, models or a tokenizer; they are tested by brute force.
ORACLES: dict[str, str] = {
    "op2_search": op2_sql(),
    "op3_substrings": op3_sql(),
    "op10_url_filters": op10_sql(),
    "op11_phrases": op11_sql(),
}
