"""Every registered query against its SQL on DuckDB, and the shape of the contract."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_module
from tests.compare import connect, difference

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF)
    assert len(set(result.columns)) == len(result.columns)
    if name in ORACLES:
        assert difference(result, duck, ORACLES[name]) is None
        assert duck.execute(ORACLES[name]).fetchall(), "the check must not be empty"
    else:
        result.count()


def test_contract():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["risk_band_name", "impacts"]
    assert df.count() > 0


def test_compare_notices_differences(spark, duck):
    df = spark.sql("SELECT 1 AS a, 'x' AS b")
    assert difference(df, duck, "SELECT 1 AS a, 'x' AS b") is None
    assert difference(df, duck, "SELECT 1 AS a, 'y' AS b")
    assert difference(df, duck, "SELECT 1 AS a, 'x' AS c")
    assert difference(df, duck, "SELECT '1' AS a, 'x' AS b")
    assert difference(df, duck, "SELECT 1 AS a, 'x' AS b UNION ALL SELECT 1, 'x'")
