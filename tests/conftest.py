"""One local session for all tests, and small helpers."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from statforge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="statforge-test-")
    session = local_session(4, "statforge-tests", spark__checkpoint__dir=shared, spark__sql__shuffle__partitions="4")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows(df, *order):
    """Collected rows as tuples, sorted when ``order`` is given."""
    if order:
        df = df.orderBy(*order)
    return [tuple(r) for r in df.collect()]


def one(df):
    found = df.collect()
    assert len(found) == 1
    return found[0].asDict()
