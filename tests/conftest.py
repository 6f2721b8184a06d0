from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from strata.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("strata-tests", 8, "4g")


@pytest.fixture
def table(spark):
    """Build a small frame: table('a string, b int', (...), (...))."""
    return lambda schema, *rows: spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
