import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from basketry.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("basketry-tests", "4", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def values(spark):
    """Apply a Column function to literal texts and return the results in order."""

    def apply(function, texts, kind="string"):
        rows = spark.createDataFrame(list(enumerate(texts)), f"n int, t {kind}")
        return [r[0] for r in rows.orderBy("n").select(function("t")).collect()]

    return apply
