import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from tidemark.plans.catalogue import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, database, name):
    assert compare(spark, database, SF, QUERIES[name], ORACLE[name]) == []


def test_entry_offers_the_catalogue():
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
