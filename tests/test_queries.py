"""Every registered query against its SQL, or at least for rows."""

import pytest

import __spark_entry__ as contract
from tests.compare import differences

from tidegrid.plans.oracles import ORACLES
from tidegrid.plans.queries import QUERIES


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["time", "day_number", "daily_mean", "running_mean"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, tables, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert differences(df, tables, ORACLES[name]) is None
    else:
        assert df.count() > 0
