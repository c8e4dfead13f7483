from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from namelens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Tiny inputs: compiling each plan would take longer than running it.
    settings = {"spark.sql.shuffle.partitions": "4", "spark.sql.codegen.wholeStage": "false"}
    session = local_session(8, "8g", **settings)
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Make a DataFrame from tuples and a DDL schema."""
    return lambda data, ddl: spark.createDataFrame(data, ddl)
