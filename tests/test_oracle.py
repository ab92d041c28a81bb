"""Every registered query against its DuckDB twin (the correctness gate), on sf0.001.

Set BARFRAME_ORACLE_SF=/root/testdata/sf0.01 to run the gate's own scale.
"""
import os

import pytest

import __spark_entry__ as E
from barframe.plans import catalog
from oracle_util import compare, duck

# The library's own queries; the optional parts test theirs.
SF = os.environ.get("BARFRAME_ORACLE_SF", "/root/testdata/sf0.001")
SQL = catalog.SQL
ROWS_ONLY = sorted(set(catalog.QUERIES) - set(SQL))


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    r = compare(E.queries()[name](spark, SF), con, SQL[name])
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_queries_run(spark, name):
    df = E.queries()[name](spark, SF)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["symbol", "start_idx", "step", "open", "close", "low", "high", "volume", "label"]


def test_every_query_has_oracle_or_is_model_or_stream():
    allowed = {"price_class_mlp", "vector_classifier", "window_regressor", "model_forecast", "symbol_regressor"}
    assert set(ROWS_ONLY) <= allowed
