"""Every registered query against its oracle on the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_point
from millrace.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return connect(SF)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"lsh_topk"}


def test_entry_gives_the_order_fact(spark):
    df = entry_point.entry(spark)
    assert df.count() > 6000 and len(df.columns) == 19


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert differences(df, oracle, ORACLES[name]) == []
    else:
        assert df.count() > 0
