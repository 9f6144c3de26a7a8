"""Every registered query against its SQL twin on the smallest data set."""

import pytest
from check_oracles import compare

from catalogspark.plans import load

QUERIES, ORACLES = load()
SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    diff, _ = compare(spark, SMALL, name, QUERIES[name], ORACLES.get(name))
    assert diff is None


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
