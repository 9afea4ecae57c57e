"""Every query against its SQL, on the small tables."""

import pytest
from parity_check import compare, connect

from pactloom.parity import CASES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(CASES))
def test_agrees_with_sql(spark, duck, name):
    assert compare(spark, duck, CASES[name], SF_DIR) is None


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(CASES) <= set(entry.queries())
