"""Every registered query against its DuckDB oracle on the sf0.001 driver tables."""

import pytest

from cordon.plans.catalog import QUERIES
from cordon.plans.oracle import ORACLE
from oracle_compare import compare, duck_connection


@pytest.fixture(scope="module")
def con(sf_small):
    return duck_connection(sf_small)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_small, con, name):
    r = compare(QUERIES[name](spark, sf_small), con, ORACLE[name])
    assert r["columns_match"], r
    assert not r["types_differ"], r
    assert r["rows_spark"] == r["rows_oracle"], r
    assert r["values_match"], r


def test_entry_contract(spark):
    import importlib.util
    import os

    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.columns == ["source_file", "taxi_type", "ghost_flag", "trip_count", "avg_speed_mph", "avg_fare",
                          "avg_distance"]
    assert df.count() > 0
    assert set(QUERIES) <= set(mod.queries()) and set(ORACLE) <= set(mod.oracle_sql()) <= set(mod.queries())
