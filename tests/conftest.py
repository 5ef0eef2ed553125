from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyweave.session import local_session  # noqa: E402
from tallyweave.sources.versioned import VersionedStore  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    yield session


@pytest.fixture
def store(spark, tmp_path):
    return VersionedStore(spark, str(tmp_path / "store"))


def values(df, *columns):
    """Rows of the given columns as a sorted list of tuples."""
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)
