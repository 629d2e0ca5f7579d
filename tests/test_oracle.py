"""Every registered query with SQL gives the same rows as DuckDB on the smallest tables."""

import compare
import pytest

from reviewmill.plans.oracle import ORACLES
from reviewmill.plans.queries import REGISTERED

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(REGISTERED)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    assert compare.differences(REGISTERED[name](spark, SF), duck, ORACLES[name]) == []


def test_stems_cover_all_terms(spark):
    stems = REGISTERED["stem_map"](spark, SF)
    terms = REGISTERED["term_freq"](spark, SF)
    assert stems.count() == terms.count()
    assert stems.where("stem = '' OR length(stem) > length(term) + 1").count() == 0


def test_entry(spark):
    import __spark_entry__ as driver

    totals = [r["total_tokens"] for r in driver.entry(spark).orderBy("step_no").collect()]
    assert len(totals) == 5 and totals == sorted(totals, reverse=True)
    assert set(driver.oracle_sql()) <= set(driver.queries())
