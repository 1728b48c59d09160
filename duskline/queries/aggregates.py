"""Aggregations, KPIs and data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from duskline.functions.text import notice_class
from duskline.operators import rollups
from duskline.operators.tags import pivot_tags
from duskline.plans import kpis, quality
from duskline.queries import entities as e
from duskline.queries.projections import landed_notices
from duskline.queries.registry import query, table
from duskline.sources import reference


@query("group_count", "SELECT l_returnflag, l_linestatus, count(*) AS row_count FROM lineitem GROUP BY 1, 2")
def group_count(spark, sf):
    return rollups.group_count(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@query("group_max", "SELECT o_custkey, strftime(max(o_orderdate), '%Y-%m-%d') AS last_seen FROM orders GROUP BY 1")
def group_max(spark, sf):
    newest = table(spark, sf, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_seen"))
    return newest.withColumn("last_seen", F.date_format("last_seen", "yyyy-MM-dd"))


@query(
    "tag_pivot",
    """
    WITH newest AS (SELECT user_id, lower(event_type) AS k, min(props) AS v FROM
        (SELECT *, rank() OVER (PARTITION BY user_id, lower(event_type) ORDER BY CAST(ts AS DATE) DESC) AS r FROM events) WHERE r = 1 GROUP BY 1, 2)
    SELECT user_id AS resource_id, max(v) FILTER (k = 'view') AS "view", max(v) FILTER (k = 'click') AS click, max(v) FILTER (k = 'error') AS error
    FROM newest WHERE k IN ('view', 'click', 'error') GROUP BY 1
    """,
)
def tag_pivot(spark, sf):
    tags = table(spark, sf, "events").select(
        F.col("user_id").alias("resource_id"),
        F.when(F.col("event_id") % 2 == 0, F.upper("event_type")).otherwise(F.col("event_type")).alias("tag_key"),
        F.col("props").alias("tag_value"),
        F.to_date("ts").alias("collected_on"),
    )
    return pivot_tags(tags, ("view", "click", "error"), newest="collected_on")


@query("tech_rollup", "SELECT * FROM rollup")
def tech_rollup(spark, sf):
    return rollups.technology_rollup(e.asset_technology(spark, sf))


@query(
    "env_distribution",
    "SELECT environment, count(*) AS total_assets, count(DISTINCT owner_team) AS teams, count(DISTINCT region) AS regions FROM asset GROUP BY 1",
)
def env_distribution(spark, sf):
    return kpis.environment_distribution(e.assets(spark, sf))


@query(
    "conditional_sum",
    "SELECT l_shipmonth, count(*) AS total_assets, count_if(l_returnflag = 'R') AS returned FROM (SELECT *, month(l_shipdate)::INTEGER AS l_shipmonth FROM lineitem) GROUP BY 1",
)
def conditional_sum(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("l_shipmonth", F.month("l_shipdate"))
    return rows.groupBy("l_shipmonth").agg(rollups.row_count("total_assets"), F.count_if(F.col("l_returnflag") == "R").alias("returned"))


@query("owner_rollup", "SELECT owner_team, count(*) AS total_assets, count(DISTINCT asset_type) AS asset_types FROM asset GROUP BY 1")
def owner_rollup(spark, sf):
    return kpis.owner_rollup(e.assets(spark, sf))


@query("global_count", "SELECT count(*) AS row_count FROM lineitem")
def global_count(spark, sf):
    return table(spark, sf, "lineitem").agg(rollups.row_count())


@query("distinct", "SELECT DISTINCT technology_family, technology_source, runtime_name, runtime_version FROM sparse_tech")
def distinct(spark, sf):
    cols = ["technology_family", "technology_source", "runtime_name", "runtime_version"]
    return e.sparse_technology(spark, sf).select(*cols).distinct()


@query("drop_duplicates", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def drop_duplicates(spark, sf):
    return table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").dropDuplicates(["l_partkey", "l_suppkey"])


@query("null_count", "SELECT count_if(runtime_name IS NULL) AS runtime_name_nulls, count_if(runtime_version IS NULL) AS runtime_version_nulls FROM sparse_tech")
def null_count(spark, sf):
    return rollups.null_counts(e.sparse_technology(spark, sf), "runtime_name", "runtime_version")


@query("distinct_file_count", "SELECT count(DISTINCT source_path) AS files FROM landed_notice")
def distinct_file_count(spark, sf):
    return landed_notices(spark, sf).agg(F.count_distinct("source_path").alias("files"))


# -- KPIs -------------------------------------------------------------------------------------
@query("kpi_assets_by_type", "SELECT cloud_provider, asset_type, count(*) AS total_assets FROM asset GROUP BY 1, 2 ORDER BY total_assets DESC, 1, 2")
def kpi_assets_by_type(spark, sf):
    return kpis.largest(kpis.assets_by_type(e.assets(spark, sf)), "total_assets", "cloud_provider", "asset_type")


@query("kpi_env", "SELECT environment, count(*) AS total_assets, count(DISTINCT owner_team) AS teams, count(DISTINCT region) AS regions FROM asset GROUP BY 1 ORDER BY 2 DESC, 1")
def kpi_env(spark, sf):
    return kpis.largest(kpis.environment_distribution(e.assets(spark, sf)), "total_assets", "environment")


@query(
    "kpi_tech",
    """
    SELECT technology_family, runtime_name, runtime_version, count(*) AS total_assets
    FROM asset LEFT JOIN asset_tech ON native_resource_id = resource_id GROUP BY 1, 2, 3
    ORDER BY total_assets DESC, 1 NULLS FIRST, 2 NULLS FIRST, 3 NULLS FIRST
    """,
)
def kpi_tech(spark, sf):
    usage = kpis.technology_usage(e.assets(spark, sf), e.asset_technology(spark, sf))
    return kpis.largest(usage, "total_assets", "technology_family", "runtime_name", "runtime_version")


@query(
    "kpi_criticality",
    "SELECT criticality, count(*) AS total_assets, count_if(has_technology) AS with_technology, count_if(NOT has_technology) AS without_technology FROM inventory GROUP BY 1",
)
def kpi_criticality(spark, sf):
    return kpis.largest(kpis.criticality_coverage(e.inventory(spark, sf)), "total_assets", "criticality")


@query("kpi_region", "SELECT region, count(*) AS total_assets FROM asset GROUP BY 1 ORDER BY 2 DESC, 1")
def kpi_region(spark, sf):
    return kpis.largest(kpis.assets_by_region(e.assets(spark, sf)), "total_assets", "region")


@query("kpi_no_tech", "SELECT asset_type, environment, count(*) AS total_assets FROM inventory WHERE NOT has_technology GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2")
def kpi_no_tech(spark, sf):
    return kpis.largest(kpis.assets_without_technology(e.inventory(spark, sf)), "total_assets", "asset_type", "environment")


@query("kpi_no_tech_total", "SELECT count(*) AS total_assets FROM inventory WHERE NOT has_technology")
def kpi_no_tech_total(spark, sf):
    return e.inventory(spark, sf).filter(~F.col("has_technology")).agg(rollups.row_count("total_assets"))


@query("kpi_owner", "SELECT owner_team, count(*) AS total_assets, count(DISTINCT asset_type) AS asset_types FROM asset GROUP BY 1 ORDER BY 2 DESC, 1")
def kpi_owner(spark, sf):
    return kpis.largest(kpis.owner_rollup(e.assets(spark, sf)), "total_assets", "owner_team")


@query(
    "kpi_due_windows",
    """
    SELECT count(DISTINCT CASE WHEN days_to_retirement <= 0 THEN asset_sk END) AS affected_now,
           count(DISTINCT CASE WHEN days_to_retirement BETWEEN 1 AND 30 THEN asset_sk END) AS due_30d,
           count(DISTINCT CASE WHEN days_to_retirement BETWEEN 1 AND 60 THEN asset_sk END) AS due_60d,
           count(DISTINCT CASE WHEN days_to_retirement BETWEEN 1 AND 90 THEN asset_sk END) AS due_90d
    FROM impact
    """,
)
def kpi_due_windows(spark, sf):
    return kpis.due_windows(e.impact(spark, sf))


# -- data quality -------------------------------------------------------------------------------
@query("dq_duplicates", "SELECT account_id || '|' || asset_type AS asset_nk, count(*) AS row_count FROM asset GROUP BY 1 HAVING count(*) > 1")
def dq_duplicates(spark, sf):
    assets = e.assets(spark, sf).withColumn("asset_nk", F.concat_ws("|", "account_id", "asset_type"))
    return quality.duplicate_assets(assets)


@query("dq_nulls", "SELECT count_if(p_size % 5 = 0) AS asset_type_nulls, count_if(p_brand = 'Brand#1') AS cloud_provider_nulls FROM part")
def dq_nulls(spark, sf):
    rows = table(spark, sf, "part").select(
        F.when(F.col("p_size") % 5 != 0, F.col("p_type")).alias("asset_type"),
        F.when(F.col("p_brand") != "Brand#1", F.col("p_brand")).alias("cloud_provider"),
    )
    return quality.asset_nulls(rows)


@query("dq_unmatched", "SELECT region, count(*) AS row_count FROM asset WHERE native_resource_id NOT IN (SELECT resource_id FROM asset_tech) GROUP BY 1")
def dq_unmatched(spark, sf):
    return rollups.group_count(quality.unmatched_assets(e.assets(spark, sf), e.asset_technology(spark, sf)), "region")


@query("dq_nonempty", "SELECT count(*) AS row_count FROM orders")
def dq_nonempty(spark, sf):
    return quality.require_rows(table(spark, sf, "orders"), "orders").agg(rollups.row_count())


@query("dq_null_keys", "SELECT resource_id FROM sparse_tech WHERE runtime_name IS NULL OR runtime_version IS NULL")
def dq_null_keys(spark, sf):
    return quality.null_keys(e.sparse_technology(spark, sf), "runtime_name", "runtime_version").select("resource_id")


@query("dq_unclassified", "SELECT doc_id FROM documents WHERE NOT lower(source || ' ' || text) LIKE '%key vault%' AND NOT (lower(source || ' ' || text) LIKE '%python%' AND lower(source || ' ' || text) LIKE '%function%')")
def dq_unclassified(spark, sf):
    docs = table(spark, sf, "documents").withColumn("notice_class", notice_class("source", "text"))
    return quality.unclassified_notices(docs).select("doc_id")


@query("dq_owner_criticality", "SELECT asset_sk FROM asset WHERE owner_team = 'unknown' OR criticality = 'unknown'")
def dq_owner_criticality(spark, sf):
    return quality.without_owner_or_criticality(e.assets(spark, sf)).select("asset_sk")


@query(
    "dq_retirement_dates",
    "SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' OR (o_orderpriority = '2-HIGH' AND day(o_orderdate) > 1)",
)
def dq_retirement_dates(spark, sf):
    level = F.col("o_orderpriority")
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(level == "1-URGENT", F.date_format("o_orderdate", "yyyy-'13'-dd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("retire_date"),
        F.when(level == "2-HIGH", F.trunc("o_orderdate", "month")).otherwise(F.to_date("o_orderdate")).alias("retirement_at"),
        F.to_date("o_orderdate").alias("published_at"),
    )
    return quality.invalid_retirement_dates(rows).select("o_orderkey")


@query("dq_orphans", "SELECT l_partkey AS key, count(*) AS row_count FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type <> 'PROMO') GROUP BY 1")
def dq_orphans(spark, sf):
    dim = table(spark, sf, "part").filter("p_type <> 'PROMO'")
    return quality.orphan_keys(table(spark, sf, "lineitem"), "l_partkey", dim, "p_partkey")


@query("dq_critical_rows", "SELECT asset_sk, deprecation_sk, technology_sk FROM impact WHERE risk_band_sk = '1'")
def dq_critical_rows(spark, sf):
    rows = quality.critical_rows(e.impact(spark, sf), reference.dim_risk_band(spark))
    return rows.select("asset_sk", "deprecation_sk", "technology_sk")
