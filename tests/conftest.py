import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from reviewmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "reviewmill-tests")


@pytest.fixture
def many_partitions(spark):
    """Keeps small shuffles in several partitions, so that ties between partitions are tested."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield spark
    spark.conf.set(key, "true")
