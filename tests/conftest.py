import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from folioforge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4)


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def rows(spark):
    """Build a DataFrame from a DDL schema and tuples."""

    def build(schema, *tuples):
        return spark.createDataFrame(list(tuples), schema)

    return build
