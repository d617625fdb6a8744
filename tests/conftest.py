from __future__ import annotations

import sys
from datetime import UTC, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tributary import schemas  # noqa: E402
from tributary.literals import literal_table  # noqa: E402
from tributary.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, 4)
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """``table("a int, b string", rows)``."""

    def make(columns: str, rows):
        return literal_table(spark, rows, schemas.struct(columns))

    return make


@pytest.fixture
def values(spark):
    """Apply a column function to a list of texts and return the results in order."""
    from pyspark.sql import functions as F

    def apply(function, texts):
        schema = schemas.struct("place int, text string")
        df = literal_table(spark, list(enumerate(texts)), schema)
        rows = df.select("place", function(F.col("text")).alias("out")).orderBy("place")
        return [row.out for row in rows.collect()]

    return apply


@pytest.fixture(scope="session")
def as_of():
    return datetime(2024, 4, 1, tzinfo=UTC)
