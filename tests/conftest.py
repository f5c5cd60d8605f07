from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallywork.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, "4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def feeds(spark):
    from tallywork.sources.adapters import Feeds

    return Feeds(spark, SF_SMALL)


@pytest.fixture
def frame(spark):
    """DataFrame from a DDL schema and rows."""
    return lambda schema, rows: spark.createDataFrame(rows, schema)


def at(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


def rows_of(df, *columns):
    """Rows of the given columns as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))
