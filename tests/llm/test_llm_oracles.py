"""Queries that SQL can express give DuckDB's rows."""

import compare
import pytest

from reviewmill.llm.oracle import ORACLES
from reviewmill.llm.queries import REGISTERED

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert compare.differences(REGISTERED[name](spark, SF), compare.connect(SF), ORACLES[name]) == []


def test_all_queries():
    numbers = sorted(int(name[2:].split("_")[0]) for name in REGISTERED)
    assert numbers == list(range(1, 14))
