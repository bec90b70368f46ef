"""Every registered query at the smallest scale, against its SQL."""

import pytest

from tests.compare import check, connect
from workload import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    outcome, _ = check(spark, con, name, SF)
    assert outcome.startswith("ok" if name in ORACLES else "rows only"), outcome
    assert not outcome.endswith(" 0") and "types" not in outcome, outcome


def test_entry(spark):
    import __spark_entry__ as driver
    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
