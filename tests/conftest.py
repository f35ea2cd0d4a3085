from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from obsharmony.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4, "obsharmony-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Small DataFrame from a DDL schema and rows."""

    def build(schema: str, rows):
        return spark.createDataFrame([tuple(r) for r in rows], schema)

    return build
