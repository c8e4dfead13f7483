from __future__ import annotations

import pytest

from namelens.llm.stored import workers_find_package

DOCS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, _key string, "
    "ids int, shard string, spans string, kept_text string, copy boolean, places string, hash int, _row string"
)


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    workers_find_package(spark)


def document(doc_id, text, source="a"):
    return (doc_id, text, "en", source, None, "k", 1, "s", "x", "t", True, "p", 7, "r")


@pytest.fixture(scope="session")
def docs(spark):
    """Make documents whose further columns bear names that operators use."""
    return lambda rows: spark.createDataFrame([document(*r) for r in rows], DOCS)


LONG = " ".join(f"word{i % 997}x{i}" for i in range(40_000))


@pytest.fixture(scope="session")
def awkward(docs):
    """Nulls, empty and blank texts, a very long one, repeated rows, equal ids."""
    return docs(
        [
            (1, "alpha beta gamma delta epsilon zeta"),
            (1, "alpha beta gamma delta epsilon zeta"),
            (2, "alpha beta gamma delta epsilon zeta"),
            (3, None, None),
            (4, "", ""),
            (5, " \n\t \n"),
            (None, "text without an id"),
            (None, None, None),
            (6, LONG),
            (7, "one id\nfirst text"),
            (7, "one id\nother text"),
            (8, "émile 日本語 🙂 \x85 x"),
        ]
    )


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


def stated(df):
    """Rows as tuples in any order."""
    return sorted(map(tuple, df.collect()), key=repr)
