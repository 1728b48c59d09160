"""The plans Spark makes: what is pushed down, what is limited early, what never appears."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from duskline.operators.dedupe import latest_per_key
from duskline.operators.technology import detect_technology
from duskline.plans import bronze
from duskline.queries import QUERIES
from duskline.queries.projections import loaded_resources

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert word not in text
    if "Window [" in text:
        assert "WindowGroupLimit" in text


def test_newest_row_is_limited_before_the_shuffle(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet")
    text = plan(latest_per_key(df, ["o_custkey"], ["o_orderdate", "o_orderkey"]))
    assert re.search(r"WindowGroupLimit .*Partial", text)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["table_scan"](spark, SF).filter("l_quantity > 45"))
    assert "GreaterThan(l_quantity,45.0)" in text
    assert "l_shipdate" not in text and "l_comment" not in text


def test_detection_reads_its_input_once(spark):
    text = plan(detect_technology(bronze.flatten_resource(loaded_resources(spark, SF))))
    assert text.count("FileScan") == 1 and "Union" not in text and "Exchange" not in text


def test_top_n_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["count_desc"](spark, SF))


def test_match_has_no_residual_condition(spark):
    text = plan(QUERIES["wildcard_match"](spark, SF))
    assert not re.search(r"Join .* OR ", text)
    assert F is not None
