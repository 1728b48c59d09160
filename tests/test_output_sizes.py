"""Joins that read little and put out much get tasks by what they put out."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from duskline.operators import matching
from duskline.plans import reports as report_plans
from duskline.queries import entities, joins, reports, tables

NOTICES, PARTS = 400, 8000


@pytest.fixture(scope="module")
def many_matches(spark, tmp_path_factory):
    """Notices and parts of one family: few bytes, many matches."""
    sf = str(tmp_path_factory.mktemp("many"))
    save = lambda df, name: df.coalesce(1).write.parquet(f"{sf}/{name}.parquet")
    n = spark.range(1, NOTICES + 1)
    p = spark.range(1, PARTS + 1)
    save(n.select(F.col("id").alias("s_suppkey"), F.lit(0).cast("long").alias("s_nationkey"), F.concat(F.lit("s"), "id").alias("s_name")), "supplier")
    day = F.timestamp_add("DAY", (F.col("id") % 300).cast("int"), F.lit("1997-06-01 00:00:00").cast("timestamp_ntz"))
    order = n.select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("O").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"),
        day.alias("o_orderdate"), F.lit("5-LOW").alias("o_orderpriority"),
    )
    save(order, "orders")
    save(p.select(
        F.col("id").alias("p_partkey"), F.lit("Brand#1").alias("p_brand"), F.element_at(F.array(F.lit("PROMO"), F.lit("LARGE"), F.lit("SMALL")), (F.col("id") % 3 + 1).cast("int")).alias("p_type"),
        (F.col("id") % 50 + 1).cast("int").alias("p_size"),
    ), "part")
    save(p.select(
        F.col("id").alias("c_custkey"), F.concat(F.lit("c"), F.col("id") % 900).alias("c_name"), F.lit(0).cast("long").alias("c_nationkey"),
        F.lit("BUILDING").alias("c_mktsegment"), F.lit(1.0).alias("c_acctbal"),
    ), "customer")
    save(spark.sql("SELECT 0L AS n_nationkey, 'N' AS n_name, 0L AS n_regionkey"), "nation")
    save(spark.sql("SELECT 0L AS r_regionkey, 'R' AS r_name"), "region")
    return sf


def tasks_with_rows(df):
    return df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).count()


def test_wildcard_match_is_dealt_by_its_matches(spark, many_matches):
    assert tasks_with_rows(joins.wildcard_match(spark, many_matches)) > 3


def test_hot_triples_go_by_matches(spark):
    """A triple with few technology rows and many notices is hot."""
    notices = spark.range(300).selectExpr("id AS deprecation_sk", "'f' AS technology_family", "'' AS affected_runtime", "CAST(NULL AS STRING) AS affected_version")
    tech = spark.range(40).selectExpr("concat('r', id) AS resource_id", "'f' AS technology_family", "'x' AS runtime_name", "'1' AS runtime_version")
    found = matching.wildcard_match(notices, tech, share=0.1, min_rows=300)
    assert found.count() == 300 * 40
    counts = matching.asked_counts(notices, matching.triple_counts(tech)).collect()
    assert [(r["technology_rows"], r["notices"]) for r in counts] == [(40, 300)]


def test_matches_are_made_after_the_join(spark, many_matches):
    """Technology rows of a triple go through the last join as lists."""
    plan = tables.build_match(spark, many_matches)._jdf.queryExecution().optimizedPlan().toString()
    assert -1 < plan.find("Generate inline") < plan.find("Join Inner")


@pytest.mark.parametrize("min_rows", [50, 1_000_000])
def test_listed_rows_match_like_single_ones(spark, min_rows):
    """Equal rows, missing values and rows that are only a triple, with salts and without."""
    notices = spark.createDataFrame(
        [(i, f, n, v) for i, (f, n, v) in enumerate([("F", None, " "), ("f", "X", None), ("f", "x", "1"), ("f", "x", "1"), ("g", "", "2"), (None, None, None), ("h", None, None)])],
        "deprecation_sk int, technology_family string, affected_runtime string, affected_version string",
    )
    rows = [("r1", "f", "x", "1"), ("r1", "f", "x", "1"), (None, "f", "x", "1"), ("r2", "F", "X", "1"), ("r3", "f", None, None), ("r4", "g", None, "2"), ("r5", None, "x", "1"), ("r6", "q", "x", "1")]
    rows += [(f"s{i}", "f", "x", str(i % 2)) for i in range(300)]
    tech = spark.createDataFrame(rows, "resource_id string, technology_family string, runtime_name string, runtime_version string")
    for t in (tech, tech.drop("resource_id"), tech.withColumn("source", F.lit("s"))):
        got = matching.wildcard_match(notices, t, share=0.0, min_rows=min_rows)
        want = matching.wildcard_match_condition(notices, t)
        assert got.columns == want.columns
        found = Counter(map(tuple, got.collect()))
        assert found == Counter(map(tuple, want.collect())) and found.total() > 600


def test_build_match_writes_dates_before_the_match(spark, many_matches):
    plan = tables.build_match(spark, many_matches)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joined = next(i for i, line in enumerate(plan) if "Join Inner" in line)
    assert not any("date_format" in line for line in plan[: joined + 1])


def test_fact_impact_is_dealt_by_its_rows(spark, many_matches):
    fact = entities.impact(spark, many_matches)
    assert tasks_with_rows(fact) > 4  # the session's shuffle partitions


def test_alert_table_moves_its_lines_once(spark, many_matches):
    table = reports.rpt_alert_table(spark, many_matches)
    order = ("days_to_retirement", "asset_name", "environment", "runtime_name", "runtime_version")
    rows = [tuple((r[c] is not None, r[c]) for c in order) for r in table.collect()]
    assert rows == sorted(rows) and table.distinct().count() == len(rows) > 100_000
    shown = table._jdf.queryExecution().executedPlan().toString().split("Join", 1)[0]
    assert shown.count("Exchange") == 1
    # The same lines from the fact.
    fact = entities.impact(spark, many_matches).select("asset_sk", "technology_sk", "risk_band_sk", "days_to_retirement", "priority")
    named = fact.join(entities.assets(spark, many_matches), "asset_sk").join(entities.dim_technology(spark, many_matches), "technology_sk")
    assert named.select("asset_name", "environment", "runtime_name", "runtime_version", "days_to_retirement", "priority", "risk_band_sk").distinct().count() == len(rows)


def test_alert_lines_are_made_after_they_are_dealt(spark, many_matches):
    """Days of a place are shuffled as one row per range, not line by line."""
    plan = reports.rpt_alert_table(spark, many_matches)._jdf.queryExecution().optimizedPlan().toString()
    assert -1 < plan.find("Generate explode") < plan.find("RepartitionByExpression")


def test_alert_table_of_crowded_and_missing_days(spark):
    """A day with most lines is split, missing days and names come first, and equal lines of two technologies are one."""
    names = [None, *[f"n{i:02d}" for i in range(20)]]
    assets = spark.createDataFrame([(f"a{i}", n, "prod" if i % 2 else None) for i, n in enumerate(names)], "asset_sk string, asset_name string, environment string")
    technologies = spark.createDataFrame([("t1", "x", "1"), ("t2", "x", "1"), ("t3", None, "2")], "technology_sk string, runtime_name string, runtime_version string")
    places = [(t, f"a{i}") for i in range(21) for t in (("t1", "t2") if i % 3 else ("t3",))]
    dated = [("c1", f"d{i}", day, priority, band) for i, (day, priority, band) in enumerate(
        [(7, "low", "1"), (7, "high", "2"), (7, "medium", "3"), (7, None, "4"), (None, "low", "4"), (-3, "low", "1"), (9, "low", "4"), (9, "high", "2"), (300, "low", "9")])]
    covers = [("c1", "t1"), ("c1", "t2"), ("c1", "t3")]
    bands = spark.createDataFrame([(str(i), f"b{i}") for i in range(1, 5)], "risk_band_sk string, risk_band_name string")
    table = report_plans.exposed_alert_table(
        spark.createDataFrame(places, "technology_sk string, asset_sk string"),
        spark.createDataFrame(dated, "notice_class string, deprecation_sk string, days_to_retirement int, priority string, risk_band_sk string"),
        spark.createDataFrame(covers, "notice_class string, technology_sk string"), assets, technologies, bands,
    )
    got = [tuple(r) for r in table.collect()]
    named = {r["asset_sk"]: (r["asset_name"], r["environment"]) for r in assets.collect()}
    runs = {r["technology_sk"]: (r["runtime_name"], r["runtime_version"]) for r in technologies.collect()}
    want = {(*named[a], *runs[t], day, priority, "pendiente", f"b{band}" if band < "5" else None) for t, a in places for _, _, day, priority, band in dated}
    assert set(got) == want and len(got) == len(want)
    order = [tuple((r[i] is not None, r[i]) for i in (4, 0, 1, 2, 3)) for r in got]
    assert order == sorted(order)
    parts = table.filter("days_to_retirement = 7").select(F.spark_partition_id()).distinct().count()
    assert parts > 1
