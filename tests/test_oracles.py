"""Every registered query equals its SQL."""

import pytest
from check_oracles import compare, duck

import __spark_entry__ as entry_module
from tradewind.plans.registry import load_all

SF = "/root/testdata/sf0.001"
QUERIES, SQL = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_module.queries()) and set(SQL) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    n, _, problem = compare(spark, con, name, QUERIES[name], SQL[name], SF)
    assert problem is None
    if name not in {"selected_imports_cube", "deepest_level_filter"}:      # too narrow for the smallest data
        assert n > 0


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["source_id", "target_id", "value"]
