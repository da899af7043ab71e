from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture
def frame(spark):
    """Build a frame from rows and a DDL schema."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


def rows(df) -> list[tuple]:
    """All rows as tuples, in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
