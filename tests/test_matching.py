"""The wildcard match: against its plain condition, with and without salting."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from duskline.operators import matching
from duskline.operators.skew import hot_keys, salted_join
from duskline.plans import gold
from duskline.plans import measures as m

NOTICE = "deprecation_sk string, technology_family string, affected_runtime string, affected_version string"
TECH = "resource_id string, technology_family string, runtime_name string, runtime_version string"
COLUMNS = ["deprecation_sk", "resource_id", *matching.TRIPLE]

families = st.sampled_from(["data", "Data", "compute", None])
asked = st.sampled_from([None, "", "  ", "sql", "SQL", "node", "1"])
has = st.sampled_from([None, "", "sql", "Sql", "node", "1"])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(families, asked, asked), min_size=1, max_size=12),
    st.lists(st.tuples(families, has, has), min_size=1, max_size=25),
)
def test_match_equals_condition(spark, rows, notices, technology):
    n = spark.createDataFrame([(f"n{i}", *x) for i, x in enumerate(notices)], NOTICE)
    t = spark.createDataFrame([(f"r{i}", *x) for i, x in enumerate(technology)], TECH)
    want = rows(matching.wildcard_match_condition(n, t), *COLUMNS)
    assert rows(matching.wildcard_match(n, t), *COLUMNS) == want
    assert rows(matching.wildcard_match(n, t, share=0.01, min_rows=1), *COLUMNS) == want


def test_hot_triple_is_spread(spark, rows):
    """One triple holds more than half of the rows; the salted join gives the same rows over several keys."""
    t = spark.range(3000).select(
        F.col("id").cast("string").alias("resource_id"), F.lit("data").alias("technology_family"),
        F.when(F.col("id") < 1800, "sql").otherwise(F.concat(F.lit("r"), F.col("id") % 40)).alias("runtime_name"),
        F.lit("1").alias("runtime_version"),
    )
    n = spark.createDataFrame([("n1", "data", "sql", None), ("n2", "DATA", None, "1"), ("n3", "data", "r3", "1")], NOTICE)
    counts = matching.with_tokens(matching.triple_counts(t))
    hot = hot_keys(counts, matching.TOKENS, "technology_rows", share=0.1, min_rows=300).collect()
    assert [(r["__token_name"], r["__salts"]) for r in hot] == [("=sql", 6)]
    got = rows(matching.wildcard_match(n, t, share=0.1, min_rows=300), "deprecation_sk", "resource_id")
    assert got == rows(matching.wildcard_match_condition(n, t), "deprecation_sk", "resource_id")
    assert len(got) == 1800 + 3000 + 30


def test_open_notices_do_not_bring_a_family_into_one_task(spark, rows):
    """Every notice leaves runtime and version open, so there is one pattern with notices x triples matches."""
    n = spark.range(60).select(
        F.concat(F.lit("n"), "id").alias("deprecation_sk"), F.lit("data").alias("technology_family"),
        F.lit(None).cast("string").alias("affected_runtime"), F.lit("").alias("affected_version"),
    )
    t = spark.range(200).select(
        F.lit("Data").alias("technology_family"), F.concat(F.lit("r"), "id").alias("runtime_name"), F.lit(None).cast("string").alias("runtime_version")
    )
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = matching.match_triples(n, t, rows_per_part=300)
        per_task = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(per_task) == 60 * 200 and max(per_task) < 0.3 * sum(per_task)
    assert matching.match_triples(n, t).distinct().count() == 60 * 200


def test_salted_join_without_hot_keys(spark, rows):
    many = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, k string")
    few = spark.createDataFrame([("a", "x"), ("a", "y"), ("c", "z")], "k string, v string")
    hot = hot_keys(many.groupBy("k").count(), ["k"], "count")
    assert hot.count() == 0
    assert rows(salted_join(many, few, ["k"], hot, ["id"]), "id", "v") == [(1, "x"), (1, "y"), (2, "x"), (2, "y")]


def test_lookup_is_null_safe_and_folded(spark):
    dim = spark.createDataFrame(
        [("k1", "Data", "b", "SQL", "1"), ("k2", "data", "a", "sql", "1"), ("k3", "data", "a", "tls", None)],
        "technology_sk string, technology_family string, technology_source string, runtime_name string, runtime_version string",
    )
    t = spark.createDataFrame([("r1", "DATA", "sql", "1"), ("r2", "data", "TLS", None), ("r3", "data", "x", None)], TECH)
    got = {r["resource_id"]: r["technology_sk"] for r in matching.lookup_technology(t, dim).collect()}
    assert got["r1"] == "k2" and got["r2"] == "k3" and len(got["r3"]) == 64


def impact_inputs(spark):
    t = spark.createDataFrame(
        [("r1", "data", "sql", "1"), ("r2", "data", "SQL", "1"), ("r3", "data", "tls", None), ("r1", "data", "tls", None), ("r9", "data", "sql", "1")],
        TECH,
    )
    assets = spark.createDataFrame([("a1", "r1"), ("a2", "r2"), ("a3", "r3"), ("a4", "r4")], "asset_sk string, native_resource_id string")
    impacted = spark.createDataFrame(
        [("n1", "data", "sql", None), ("n1", "data", "sql", None), ("n2", "data", None, None), ("n3", "network", None, None), ("n4", "data", "tls", "9")],
        NOTICE,
    )
    events = spark.createDataFrame(
        [("n1", dt.datetime(2026, 1, 20), "high", "open"), ("n2", None, "medium", "open"), ("n4", dt.datetime(2026, 1, 2), "low", "open")],
        "deprecation_sk string, retirement_at timestamp, severity string, status string",
    )
    dim = gold.dim_technology(t.withColumn("technology_source", F.lit("s")), "2026-01-01 00:00:00")
    return impacted, t, assets, events, dim


def test_fact_impact(spark, rows):
    day = dt.date(2026, 1, 1)
    inputs = impact_inputs(spark)
    for options in ({}, {"share": 0.01, "min_rows": 1}):
        fact = gold.fact_impact(*inputs, day, "2026-01-01 00:00:00", **options)
        got = rows(fact, "asset_sk", "deprecation_sk", "risk_band_sk", "priority", "days_to_retirement", "risk_score")
        # The two spellings of sql share one key in the dimension.
        assert got == [
            ("a1", "n1", "1", "high", 19, 1.0),
            ("a1", "n2", "3", "medium", None, 0.5),
            ("a1", "n2", "3", "medium", None, 0.5),
            ("a2", "n1", "1", "high", 19, 1.0),
            ("a2", "n2", "3", "medium", None, 0.5),
            ("a3", "n2", "3", "medium", None, 0.5),
        ]
        assert fact.select(*gold.IMPACT_KEYS).distinct().count() == 6


def test_exposure_measures_equal_fact_measures(spark, rows):
    day = dt.date(2026, 1, 1)
    impacted, t, assets, events, dim = impact_inputs(spark)
    fact = gold.fact_impact(impacted, t, assets, events, dim, day, "2026-01-01 00:00:00")
    a = gold.asset_exposure(t, assets, dim)
    n = gold.class_exposure(impacted, gold.known_triples(t, dim), events, day)
    want = fact.groupBy("priority").agg(
        m.impacts(), m.average_risk(), m.average_days(), m.critical_alerts(), m.nearest_days(), m.affected_technologies()
    )
    assert rows(m.exposure_totals(a, *n, "priority")) == rows(want)
    assert rows(m.exposed_assets(a, *n)) == rows(fact.select("asset_sk").distinct())
    assert rows(m.exposed_assets(a, *n, "risk_band_sk")) == rows(fact.select("asset_sk", "risk_band_sk").distinct())


def test_classes_cover_what_notices_cover(spark, rows):
    """Notices with several patterns, the same set in any order, overlapping sets, spellings and a null family."""
    day = dt.date(2026, 1, 1)
    triples = [(f"r{i}", f, n, v) for i, (f, n, v) in enumerate([(f, n, v) for f in ("data", "Data", "net") for n in ("sql", "SQL", None) for v in ("1", "2", None)])]
    t = spark.createDataFrame(triples, TECH)
    assets = spark.createDataFrame([(f"a{r[0]}", r[0]) for r in triples], "asset_sk string, native_resource_id string")
    asked = {
        "n1": [("data", "sql", None), ("data", None, "1")], "n2": [("data", None, "1"), ("DATA", "SQL", " ")],
        "n3": [("data", None, None)], "n4": [("data", None, None), ("net", "sql", "2")], "n5": [("net", None, "2"), ("net", "sql", "2")],
        "n6": [(None, None, None)], "n7": [("data", "tls", None)],
    }
    impacted = spark.createDataFrame([(k, *p) for k, ps in asked.items() for p in ps], NOTICE)
    events = spark.createDataFrame(
        [(f"n{i}", dt.datetime(2026, 1, 1) + dt.timedelta(days=40 * i), "low", "open") for i in range(1, 7)],
        "deprecation_sk string, retirement_at timestamp, severity string, status string",
    )
    dim = gold.dim_technology(t.withColumn("technology_source", F.lit("s")), "2026-01-01 00:00:00")
    known = gold.known_triples(t, dim)
    pairs = gold.notice_exposure(impacted, known, events, day)
    notices, covers = gold.class_exposure(impacted, known, events, day)
    columns = pairs.columns
    assert rows(notices.join(covers, "notice_class").select(*columns)) == rows(pairs)
    classes = dict(notices.select("deprecation_sk", "notice_class").collect())
    assert classes["n2"] == classes["n1"] == "n1" and "n6" not in classes and len(set(classes.values())) == 5
    fact = gold.fact_impact(impacted, t, assets, events, dim, day, "2026-01-01 00:00:00")
    a = gold.asset_exposure(t, assets, dim)
    for by in ([], ["risk_band_sk"], ["technology_sk"], ["technology_sk", "priority"]):
        want = fact.groupBy(*by).agg(
            m.impacts(), m.average_risk(), m.average_days(), m.critical_alerts(), m.nearest_days(), m.affected_technologies()
        )
        assert rows(m.exposure_totals(a, notices, covers, *by)) == rows(want)


def test_no_join_of_measures_has_notices_times_technologies(spark):
    """40 notices ask for one open pattern over 30 technologies: joins put out 30 rows, the pairs would be 1200."""
    day = dt.date(2026, 1, 1)
    t = spark.createDataFrame([(f"r{i}", "data", f"n{i}", "1") for i in range(30)], TECH)
    assets = spark.createDataFrame([(f"a{i}", f"r{i}") for i in range(30)], "asset_sk string, native_resource_id string")
    impacted = spark.createDataFrame([(f"n{i}", "data", None, None) for i in range(40)], NOTICE)
    events = spark.createDataFrame(
        [(f"n{i}", dt.datetime(2026, 1, 5), "low", "open") for i in range(40)],
        "deprecation_sk string, retirement_at timestamp, severity string, status string",
    )
    dim = gold.dim_technology(t.withColumn("technology_source", F.lit("s")), "2026-01-01 00:00:00")
    notices, covers = gold.class_exposure(impacted, gold.known_triples(t, dim), events, day)
    assert (notices.count(), covers.count()) == (40, 30)
    totals = m.exposure_totals(gold.asset_exposure(t, assets, dim), notices, covers, "risk_band_sk")
    assert totals.select("impacts", "affected_technologies").collect() == [(1200, 30)]


def test_crosswalk(spark):
    df = spark.createDataFrame([("app_runtime",), ("Database",), ("other",), (None,)], "technology_family string")
    assert [r[0] for r in matching.crosswalk_family(df).collect()] == ["compute", "data", "other", None]
