"""The model's entities derived from the driver tables, in Spark and in SQL.

Everything is a fixed projection of whole tables, so it grows with them. The
calculation day is 1 January 1998.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskline.functions.risk import days_to_retirement, severity
from duskline.functions.text import status_label
from duskline.plans import gold
from duskline.queries.registry import cte, table

AS_OF = dt.date(1998, 1, 1)
RUN_TS = "1998-01-01 00:00:00"


def text(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def ts_text(c) -> F.Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd HH:mm:ss")


def case(*pairs, default=None) -> F.Column:
    out = F.when(pairs[0][0], pairs[0][1])
    for test, value in pairs[1:]:
        out = out.when(test, value)
    return out if default is None else out.otherwise(default)


# -- technology rows: part ------------------------------------------------------
cte(
    "tech",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS resource_id, p_brand AS technology_family,
           CASE WHEN p_partkey % 2 = 0 THEN 'catalog' ELSE 'scan' END AS technology_source,
           p_type AS runtime_name, CAST(p_size AS VARCHAR) AS runtime_version
    FROM part
    """,
)


def technology(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        text("p_partkey").alias("resource_id"),
        F.col("p_brand").alias("technology_family"),
        F.when(F.col("p_partkey") % 2 == 0, "catalog").otherwise("scan").alias("technology_source"),
        F.col("p_type").alias("runtime_name"),
        text("p_size").alias("runtime_version"),
    )


# The same with names and versions missing on some rows.
cte(
    "sparse_tech",
    """
    SELECT resource_id, technology_family, technology_source,
           CASE WHEN CAST(resource_id AS BIGINT) % 13 = 0 THEN NULL ELSE runtime_name END AS runtime_name,
           CASE WHEN CAST(resource_id AS BIGINT) % 11 = 0 THEN NULL ELSE runtime_version END AS runtime_version
    FROM tech
    """,
)


def sparse_technology(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("resource_id").cast("long")
    return technology(spark, sf).withColumns(
        {
            "runtime_name": F.when(key % 13 != 0, F.col("runtime_name")),
            "runtime_version": F.when(key % 11 != 0, F.col("runtime_version")),
        }
    )


cte(
    "dim_tech",
    """
    SELECT sha256(concat(technology_family, '|', technology_source, '|', coalesce(runtime_name, ''), '|',
                         coalesce(runtime_version, ''))) AS technology_sk, *
    FROM (SELECT DISTINCT technology_family, technology_source, runtime_name, runtime_version FROM sparse_tech)
    """,
)


def dim_technology(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dim_technology(sparse_technology(spark, sf), RUN_TS)


# -- notices: supplier with the order of the same number --------------------------
cte(
    "notice",
    """
    SELECT 'N' || s_suppkey AS deprecation_sk, 'brand#' || (s_nationkey + 1) AS technology_family,
           CASE WHEN s_suppkey % 2 = 0 THEN NULL WHEN s_suppkey % 5 = 0 THEN ' '
                WHEN s_suppkey % 6 = 1 THEN 'promo' WHEN s_suppkey % 6 = 3 THEN 'large' ELSE 'small' END AS affected_runtime,
           CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE CAST(1 + s_suppkey % 50 AS VARCHAR) END AS affected_version,
           CASE WHEN s_suppkey % 7 = 0 THEN 'profile' END AS affected_feature,
           CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE s_name END AS affected_service,
           o_orderdate AS retirement_at, o_orderdate - INTERVAL 400 DAY AS published_at,
           CASE o_orderstatus WHEN 'F' THEN 'Retired in full' WHEN 'P' THEN 'Preview' ELSE ' Open ' END AS status,
           s_name AS title
    FROM supplier JOIN orders ON o_orderkey = s_suppkey
    """,
)


def notices(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "supplier").join(table(spark, sf, "orders"), F.col("o_orderkey") == F.col("s_suppkey"))
    k = F.col("s_suppkey")
    return joined.select(
        F.concat(F.lit("N"), text(k)).alias("deprecation_sk"),
        F.concat(F.lit("brand#"), text(F.col("s_nationkey") + 1)).alias("technology_family"),
        case(
            (k % 2 == 0, F.lit(None)), (k % 5 == 0, " "), (k % 6 == 1, "promo"), (k % 6 == 3, "large"), default="small"
        ).alias("affected_runtime"),
        F.when(k % 3 != 0, text(1 + k % 50)).alias("affected_version"),
        F.when(k % 7 == 0, "profile").alias("affected_feature"),
        F.when(k % 4 == 0, "").otherwise(F.col("s_name")).alias("affected_service"),
        F.col("o_orderdate").alias("retirement_at"),
        (F.col("o_orderdate") - F.expr("INTERVAL 400 DAY")).alias("published_at"),
        case(
            (F.col("o_orderstatus") == "F", "Retired in full"), (F.col("o_orderstatus") == "P", "Preview"), default=" Open "
        ).alias("status"),
        F.col("s_name").alias("title"),
    )


STATUS_SQL = """CASE WHEN {c} IS NULL OR trim({c}) = '' THEN 'unknown'
    WHEN lower({c}) LIKE '%retired%' THEN 'retired' WHEN lower({c}) LIKE '%retire%' THEN 'retiring'
    WHEN lower({c}) LIKE '%deprecated%' THEN 'deprecated' WHEN lower({c}) LIKE '%preview%' THEN 'preview'
    ELSE lower(trim({c})) END"""
DAYS_SQL = "CAST(date_diff('day', DATE '1998-01-01', CAST({c} AS DATE)) AS INTEGER)"
SEVERITY_SQL = """CASE WHEN {s} = 'retired' THEN 'critical' WHEN {d} IS NULL THEN 'medium' WHEN {d} <= 30 THEN 'critical'
    WHEN {d} <= 90 THEN 'high' WHEN {d} <= 180 THEN 'medium' ELSE 'low' END"""
PRIORITY_SQL = "CASE WHEN lower({s}) IN ('critical', 'high', 'medium') THEN lower({s}) ELSE 'low' END"
BAND_SQL = """CASE WHEN {d} <= 30 OR {p} = 'critical' THEN '1' WHEN {d} <= 90 OR {p} = 'high' THEN '2'
    WHEN {d} <= 180 OR {p} = 'medium' THEN '3' ELSE '4' END"""
SCORE_SQL = "CASE {b} WHEN '1' THEN 1.0::DOUBLE WHEN '2' THEN 0.75::DOUBLE WHEN '3' THEN 0.5::DOUBLE WHEN '4' THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END"

cte(
    "event",
    f"""
    SELECT *, {SEVERITY_SQL.format(s='status_norm', d='days_to_retirement')} AS severity
    FROM (SELECT *, {STATUS_SQL.format(c='status')} AS status_norm,
                 {DAYS_SQL.format(c='retirement_at')} AS days_to_retirement FROM notice)
    """,
)


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Notices with folded status and severity."""
    rows = notices(spark, sf).withColumn("status", status_label("status"))
    days = days_to_retirement("retirement_at", AS_OF)
    return rows.withColumn("days_to_retirement", days).withColumn("severity", severity(F.col("status"), F.col("days_to_retirement")))


# -- assets: customer with nation and region ---------------------------------------
cte(
    "asset",
    """
    SELECT 'A' || c_custkey AS asset_sk, CAST(c_custkey AS VARCHAR) AS native_resource_id,
           CASE n_regionkey % 3 WHEN 0 THEN 'azure' WHEN 1 THEN 'aws' ELSE 'gcp' END AS cloud_provider,
           n_name AS account_id, c_name AS asset_name, 'type-' || (c_custkey % 6) AS asset_type, r_name AS region,
           CASE c_mktsegment WHEN 'MACHINERY' THEN 'production' WHEN 'BUILDING' THEN 'staging'
                WHEN 'FURNITURE' THEN 'testing' WHEN 'HOUSEHOLD' THEN 'unknown' ELSE lower(c_mktsegment) END AS environment,
           CASE c_nationkey % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' ELSE 'unknown' END AS criticality,
           CASE WHEN c_custkey % 7 = 0 THEN 'unknown' ELSE 'team-' || (c_custkey % 7) END AS owner_team,
           CASE WHEN c_acctbal >= 1000 THEN 'Succeeded' WHEN c_acctbal >= 0 THEN 'Failed' END AS provisioning_state
    FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
    """,
)


def assets(spark: SparkSession, sf: str) -> DataFrame:
    joined = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
        .join(table(spark, sf, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    )
    k, seg, nat, bal = F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_nationkey"), F.col("c_acctbal")
    return joined.select(
        F.concat(F.lit("A"), text(k)).alias("asset_sk"),
        text(k).alias("native_resource_id"),
        case((F.col("n_regionkey") % 3 == 0, "azure"), (F.col("n_regionkey") % 3 == 1, "aws"), default="gcp").alias("cloud_provider"),
        F.col("n_name").alias("account_id"),
        F.col("c_name").alias("asset_name"),
        F.concat(F.lit("type-"), text(k % 6)).alias("asset_type"),
        F.col("r_name").alias("region"),
        case(
            (seg == "MACHINERY", "production"), (seg == "BUILDING", "staging"), (seg == "FURNITURE", "testing"),
            (seg == "HOUSEHOLD", "unknown"), default=F.lower(seg),
        ).alias("environment"),
        case((nat % 4 == 0, "high"), (nat % 4 == 1, "medium"), (nat % 4 == 2, "low"), default="unknown").alias("criticality"),
        F.when(k % 7 == 0, "unknown").otherwise(F.concat(F.lit("team-"), text(k % 7))).alias("owner_team"),
        case((bal >= 1000, "Succeeded"), (bal >= 0, "Failed")).alias("provisioning_state"),
    )


# -- technologies per asset: orders --------------------------------------------------
cte(
    "asset_tech",
    """
    SELECT CAST(CASE WHEN o_custkey % 5 = 0 THEN o_custkey + 1 ELSE o_custkey END AS VARCHAR) AS resource_id,
           o_orderstatus AS technology_family,
           CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE lower(o_orderpriority) END AS runtime_name,
           CAST(year(o_orderdate) AS VARCHAR) AS runtime_version
    FROM orders
    """,
)


def asset_technology(spark: SparkSession, sf: str) -> DataFrame:
    """Every order is a technology row; a fifth of the customers hand theirs to the next one and have none."""
    o = table(spark, sf, "orders")
    key = F.col("o_custkey")
    return o.select(
        text(F.when(key % 5 == 0, key + 1).otherwise(key)).alias("resource_id"),
        F.col("o_orderstatus").alias("technology_family"),
        F.when(F.col("o_orderpriority") != "3-MEDIUM", F.lower("o_orderpriority")).alias("runtime_name"),
        text(F.year("o_orderdate")).alias("runtime_version"),
    )


# -- facts -----------------------------------------------------------------------------
cte(
    "rollup",
    """
    SELECT resource_id, count(*) AS technology_count,
           '[' || string_agg(DISTINCT '"' || technology_family || '"', ',' ORDER BY '"' || technology_family || '"') || ']'
               AS technology_families_json,
           '[' || coalesce(string_agg(DISTINCT '"' || runtime_name || '"', ',' ORDER BY '"' || runtime_name || '"'), '') || ']'
               AS runtime_names_json
    FROM asset_tech GROUP BY 1
    """,
)
cte(
    "inventory",
    """
    SELECT 19980101 AS date_sk, asset_sk, account_id AS account_nk, cloud_provider, asset_type, region, environment,
           criticality, owner_team, provisioning_state, coalesce(provisioning_state = 'Succeeded', FALSE) AS is_active,
           CAST(coalesce(technology_count, 0) AS BIGINT) AS technology_count, coalesce(technology_count, 0) > 0 AS has_technology,
           technology_families_json, runtime_names_json, '1998-01-01' AS snapshot_date
    FROM asset LEFT JOIN rollup ON native_resource_id = resource_id
    """,
)


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    return gold.fact_inventory(assets(spark, sf), asset_technology(spark, sf), AS_OF, RUN_TS).drop("loaded_at")


cte(
    "tech_lookup",
    """
    SELECT lower(technology_family) AS f, lower(runtime_name) AS n, lower(runtime_version) AS v,
           arg_min(technology_sk, technology_source) AS dim_sk
    FROM dim_tech GROUP BY 1, 2, 3
    """,
)
cte(
    "impact",
    f"""
    SELECT DISTINCT 19980101 AS date_sk, asset_sk, deprecation_sk,
           coalesce(dim_sk, sha256(concat(technology_family, '|', coalesce(runtime_name, ''), '|', coalesce(runtime_version, '')))) AS technology_sk,
           risk_band_sk, {SCORE_SQL.format(b='risk_band_sk')} AS risk_score, TRUE AS is_affected,
           days_to_retirement, priority, 'pendiente' AS remediation_status, '1998-01-01' AS snapshot_date
    FROM (SELECT *, {BAND_SQL.format(d='days_to_retirement', p='priority')} AS risk_band_sk
          FROM (SELECT a.asset_sk, e.deprecation_sk, t.technology_family, t.runtime_name, t.runtime_version,
                       e.days_to_retirement, {PRIORITY_SQL.format(s='e.severity')} AS priority
                FROM event e JOIN sparse_tech t ON lower(e.technology_family) = lower(t.technology_family)
                  AND (e.affected_runtime IS NULL OR trim(e.affected_runtime) = '' OR lower(e.affected_runtime) = lower(t.runtime_name))
                  AND (e.affected_version IS NULL OR trim(e.affected_version) = '' OR lower(e.affected_version) = lower(t.runtime_version))
                JOIN asset a ON a.native_resource_id = t.resource_id))
    LEFT JOIN tech_lookup ON f = lower(technology_family) AND n IS NOT DISTINCT FROM lower(runtime_name)
         AND v IS NOT DISTINCT FROM lower(runtime_version)
    """,
)


def impact(spark: SparkSession, sf: str) -> DataFrame:
    ev = events(spark, sf)
    return gold.fact_impact(
        ev, sparse_technology(spark, sf), assets(spark, sf), ev, dim_technology(spark, sf), AS_OF, RUN_TS
    ).drop("loaded_at")


def exposures(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(asset side, notices, technologies of each notice class), whose join is the impact fact."""
    ev, tech, dim = events(spark, sf), sparse_technology(spark, sf), dim_technology(spark, sf)
    return (
        gold.asset_exposure(tech, assets(spark, sf), dim),
        *gold.class_exposure(ev, gold.known_triples(tech, dim), ev, AS_OF),
    )


# -- repeated snapshots of one entity: orders per customer ---------------------------------
def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders")
