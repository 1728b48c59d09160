"""Builders of the conformed entities, dimensions and facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from duskline.operators.technology import detect_technology
from duskline.plans import bronze, gold, silver
from duskline.queries import entities as e
from duskline.queries.projections import ENV_SQL, landed_notices, landed_resources, loaded_resources
from duskline.queries.registry import cte, query, table
from duskline.sources import reference

# -- notices ------------------------------------------------------------------------------
# One row per announcement, the newest file first.
cte(
    "notice_newest",
    """
    SELECT sha256('microsoft|' || created || '|' || title) AS notice_id, title,
           CASE WHEN created <> '' THEN created || ' 00:00:00' END AS published_at,
           retire_date || ' 00:00:00' AS retirement_at, status AS raw_status, source_path, retire_date
    FROM landed_notice
    QUALIFY row_number() OVER (PARTITION BY created, title ORDER BY source_path DESC, retire_date DESC) = 1
    """,
)
cte(
    "notice_base",
    f"""
    SELECT notice_id, title, published_at, retirement_at, source_path, {e.STATUS_SQL.format(c='raw_status')} AS status,
           {e.DAYS_SQL.format(c='retire_date')} AS days_to_retirement
    FROM notice_newest
    """,
)


def landed(spark, sf):
    """Landed notices whose repeats within one file are equal."""
    rows = landed_notices(spark, sf)
    one = rows.groupBy("created", "title", "source_path").agg(
        F.max(F.struct(F.col("retire_date").isNotNull(), "retire_date", "status", "retire_year")).alias("r")
    )
    return one.select("created", "title", "source_path", "r.status", "r.retire_date", "r.retire_year")


def base(spark, sf):
    return silver.notice_base(bronze.notice_bronze(landed(spark, sf), e.RUN_TS), e.AS_OF)


def stamped(df, *columns):
    """Timestamps as text."""
    for c in columns:
        df = df.withColumn(c, e.ts_text(c))
    return df


NOTICE_TIMES = ("published_at", "retirement_at")
SEEN = ("first_seen_at", "last_seen_at", "conformance_at")
# Notices that name a runtime, a feature or a version, by the customer in the title; scope and key follow.
NAMED = [f"affected_{c}" for c in ("service", "feature", "runtime", "version")]
cte(
    "named_notice",
    """
    SELECT * EXCLUDE (n), CASE WHEN n % 10 = 4 THEN '' ELSE 'azure.release_communications' END AS affected_service,
           CASE n % 5 WHEN 2 THEN 'preview ring' END AS affected_feature, CASE n % 5 WHEN 0 THEN 'Python' WHEN 1 THEN ' ' END AS affected_runtime,
           CASE n % 5 WHEN 3 THEN '3.' || (n % 10) END AS affected_version,
           CASE n % 5 WHEN 0 THEN 'runtime' WHEN 2 THEN 'feature' WHEN 3 THEN 'runtime' ELSE CASE WHEN n % 10 = 4 THEN 'configuration' ELSE 'service' END
               END AS impact_scope,
           CASE WHEN title LIKE '%AKS%' THEN 'containers' WHEN title LIKE '%Web App%' THEN 'compute' WHEN title LIKE '%Cosmos%' THEN 'data'
                WHEN title LIKE '%Blob%' THEN 'storage' WHEN title LIKE '%Key Vault%' THEN 'security' WHEN title LIKE '%DNS%' THEN 'network'
                ELSE 'platform' END AS technology_family
    FROM (SELECT *, CAST(regexp_extract(title, 'customer (\\d+)', 1) AS BIGINT) AS n FROM notice_base)
    """,
)


def named(spark, sf):
    n = F.regexp_extract("title", r"customer (\d+)", 1).cast("long")
    return base(spark, sf).withColumns(
        {
            "affected_service": F.when(n % 10 == 4, "").otherwise(F.col("affected_service")),
            "affected_feature": F.when(n % 5 == 2, "preview ring"),
            "affected_runtime": e.case((n % 5 == 0, "Python"), (n % 5 == 1, " ")),
            "affected_version": F.when(n % 5 == 3, F.concat(F.lit("3."), e.text(n % 10))),
        }
    )


SEEN_SQL = ", ".join(f"'1998-01-01 00:00:00' AS {c}" for c in SEEN)
@query("build_notice_base", "SELECT notice_id, title, published_at, retirement_at, source_path, status, days_to_retirement FROM notice_base")
def build_notice_base(spark, sf):
    cols = ["notice_id", "title", "published_at", "retirement_at", "source_path", "status", "days_to_retirement"]
    return stamped(base(spark, sf).select(*cols), *NOTICE_TIMES)


_EVENT_SQL = f"""
    SELECT sha256('microsoft|' || notice_id) AS deprecation_sk, 'microsoft' AS vendor, notice_id, title AS notice_title, technology_family,
           {', '.join(NAMED)}, published_at, retirement_at,
           {e.SEVERITY_SQL.format(s='status', d='days_to_retirement')} AS severity, impact_scope, status,
           'duskline' AS source_system, {SEEN_SQL}
    FROM named_notice
    """


@query("build_deprecation_event", _EVENT_SQL)
def build_deprecation_event(spark, sf):
    return stamped(silver.deprecation_event(named(spark, sf), e.RUN_TS), *NOTICE_TIMES, *SEEN)


@query(
    "build_source_notice",
    f"""
    SELECT sha256('microsoft|' || notice_id) AS notice_sk, 'microsoft' AS vendor, notice_id, title AS notice_title,
           CAST(NULL AS VARCHAR) AS notice_url, 'duskline' AS source_system, source_path, published_at, retirement_at, status, {SEEN_SQL}
    FROM notice_base
    """,
)
def build_source_notice(spark, sf):
    return stamped(silver.source_notice(base(spark, sf), e.RUN_TS), *NOTICE_TIMES, *SEEN)


@query(
    "build_impacted_technology",
    f"""
    SELECT sha256(technology_nk) AS technology_sk, technology_nk, technology_family, {', '.join(NAMED)},
           sha256('microsoft|' || notice_id) AS deprecation_sk, published_at, retirement_at, status, {SEEN_SQL}
    FROM (SELECT *, concat_ws('|', {', '.join(f"coalesce({c}, 'na')" for c in ('affected_service', 'affected_runtime', 'affected_version'))})
              AS technology_nk FROM named_notice)
    """,
)
def build_impacted_technology(spark, sf):
    events = silver.deprecation_event(named(spark, sf), e.RUN_TS)
    return stamped(silver.impacted_technology(events, e.RUN_TS), *NOTICE_TIMES, *SEEN)


# -- inventory ----------------------------------------------------------------------------------
@query(
    "build_cloud_account",
    f"""
    SELECT sha256('azure|' || o_custkey) AS account_sk, CAST(o_custkey AS VARCHAR) AS account_nk, 'azure' AS cloud_provider,
           arg_max(o_orderpriority, (o_orderdate, o_orderpriority)) AS account_type, {ENV_SQL.format(c='CAST(o_custkey AS VARCHAR)')} AS environment,
           strftime(min(o_orderdate), '%Y-%m-%d') AS first_seen, strftime(max(o_orderdate), '%Y-%m-%d') AS last_seen
    FROM orders GROUP BY o_custkey
    """,
)
def build_cloud_account(spark, sf):
    raw = table(spark, sf, "orders").select(
        e.text("o_custkey").alias("subscription_id"), F.col("o_orderpriority").alias("account_type"), F.col("o_orderdate").alias("collected_at")
    )
    rows = silver.cloud_account(raw, e.RUN_TS)
    return rows.select(
        "account_sk", "account_nk", "cloud_provider", "account_type", "environment",
        F.date_format("first_seen_at", "yyyy-MM-dd").alias("first_seen"), F.date_format("last_seen_at", "yyyy-MM-dd").alias("last_seen"),
    )


# Two loads of the same resources: the second moves them and drops some.
def two_loads(spark, sf):
    first = bronze.bronze_metadata(landed_resources(spark, sf), "1997-12-01 00:00:00", source_path="landing/first.json")
    again = landed_resources(spark, sf).filter("resource_group <> 'Brand#2'").withColumn("location", F.lit("ukwest"))
    second = bronze.bronze_metadata(again, e.RUN_TS, source_path="landing/second.json")
    return first.unionByName(second)


@query(
    "build_asset",
    """
    WITH one AS (SELECT *, resource_group <> 'Brand#2' AS seen_again,
        'azure|' || subscription_id || '|' || resource_type || '|' || lower(trim(resource_name)) AS asset_nk FROM resource)
    SELECT sha256(asset_nk) AS asset_sk, asset_nk, 'azure' AS cloud_provider, subscription_id AS account_id, resource_group,
           resource_id AS native_resource_id, resource_name AS asset_name, resource_type AS asset_type,
           CASE WHEN seen_again THEN 'UK West' ELSE CASE lower(location) WHEN 'eastus' THEN 'East US' WHEN 'uksouth' THEN 'UK South'
                WHEN 'westeurope' THEN 'West Europe' ELSE location END END AS region,
           coalesce(lower(trim(tag_env)), 'unknown') AS environment, 'unknown' AS criticality, lower(trim(tag_owner)) AS owner_team,
           provisioning_state, kind, sku_name, sku_tier, 'duskline' AS source_system, '1997-12-01 00:00:00' AS first_seen_at,
           CASE WHEN seen_again THEN '1998-01-01 00:00:00' ELSE '1997-12-01 00:00:00' END AS last_seen_at, '1998-01-01 00:00:00' AS conformance_at
    FROM one QUALIFY row_number() OVER (PARTITION BY asset_nk ORDER BY seen_again DESC, resource_id DESC) = 1
    """,
)
def build_asset(spark, sf):
    loads = two_loads(spark, sf)
    return stamped(silver.asset(silver.newest_resource(bronze.flatten_resource(loads)), bronze.resource_tags(loads), e.RUN_TS), *SEEN)


@query(
    "detect_technology",
    """
    SELECT resource_type, 'app_runtime' AS technology_family, lower(split_part(linux_fx, '|', 1)) AS runtime_name, count(*) AS row_count,
           count(CASE WHEN contains(linux_fx, '|') THEN 1 END) AS versions
    FROM resource WHERE linux_fx <> '' GROUP BY 1, 2, 3
    UNION ALL SELECT resource_type, 'container_orchestration', 'kubernetes', count(*), count(*) FROM resource WHERE k8s_declared IS NOT NULL GROUP BY 1
    UNION ALL SELECT resource_type, 'key_vault_config', 'rbac_authorization', count(*), 0 FROM resource WHERE rbac IS NOT NULL GROUP BY 1
    UNION ALL SELECT resource_type, 'virtual_machine', 'linux', count(*), count(*) FROM resource WHERE os_type IS NOT NULL GROUP BY 1
    UNION ALL SELECT resource_type, 'storage_config', 'tls', count(*), count(*) FROM resource WHERE min_tls IS NOT NULL GROUP BY 1
    """,
)
def detect_technology_counts(spark, sf):
    found = detect_technology(bronze.flatten_resource(loaded_resources(spark, sf)))
    return found.groupBy("resource_type", "technology_family", "runtime_name").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("runtime_version").alias("versions")
    )


@query(
    "build_asset_technology",
    """
    WITH shown AS (
        SELECT *, 'app_runtime' AS family, 'linux_fx_version' AS source, lower(split_part(linux_fx, '|', 1)) AS runtime_name,
               CASE WHEN contains(linux_fx, '|') THEN split_part(linux_fx, '|', 2) END AS runtime_version FROM resource WHERE linux_fx <> ''
        UNION ALL SELECT *, 'container_orchestration', 'kubernetes_version', 'kubernetes', coalesce(k8s_current, k8s_declared)
        FROM resource WHERE k8s_declared IS NOT NULL
        UNION ALL SELECT *, 'key_vault_config', 'rbac_authorization', 'rbac_authorization', NULL FROM resource WHERE rbac IS NOT NULL
        UNION ALL SELECT *, 'virtual_machine', 'os_image', 'linux', NULL FROM resource WHERE os_type IS NOT NULL
        UNION ALL SELECT *, 'storage_config', 'tls_version', 'tls', min_tls FROM resource WHERE min_tls IS NOT NULL
    )
    SELECT resource_id, sha256(concat(resource_id, '|', family, '|', source)) AS tech_sk,
           'azure|' || subscription_id || '|' || resource_type || '|' || lower(trim(resource_name)) AS asset_nk, resource_type,
           family AS technology_family, runtime_name, CASE WHEN family <> 'virtual_machine' THEN runtime_version END AS runtime_version
    FROM shown
    """,
)
def build_asset_technology(spark, sf):
    rows = silver.technology(silver.newest_resource(bronze.flatten_resource(two_loads(spark, sf))), e.RUN_TS)
    # The image of a virtual machine is checked by detect_technology.
    version = F.when(F.col("technology_family") != "virtual_machine", F.col("runtime_version")).alias("runtime_version")
    return rows.select("resource_id", "tech_sk", "asset_nk", "resource_type", "technology_family", "runtime_name", version)


# -- dimensions and facts ------------------------------------------------------------------------
@query(
    "build_dim_account",
    "SELECT sha256('azure|' || o_custkey) AS account_sk, CAST(o_custkey AS VARCHAR) AS account_nk, 'azure' AS cloud_provider, '1998-01-01 00:00:00' AS loaded_at FROM orders GROUP BY o_custkey",
)
def build_dim_account(spark, sf):
    raw = table(spark, sf, "orders").select(
        e.text("o_custkey").alias("subscription_id"), F.col("o_orderpriority").alias("account_type"), F.col("o_orderdate").alias("collected_at")
    )
    dim = gold.dim_account(silver.cloud_account(raw, e.RUN_TS), e.RUN_TS)
    return stamped(dim.select("account_sk", "account_nk", "cloud_provider", "loaded_at"), "loaded_at")


@query(
    "build_dim_asset",
    """
    SELECT 'O' || o_orderkey AS asset_sk, CAST(o_custkey AS VARCHAR) AS asset_nk, o_orderstatus AS region, strftime(o_orderdate, '%Y-%m-%d') AS first_seen
    FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, 'O' || o_orderkey) = 1
    """,
)
def build_dim_asset(spark, sf):
    blank = [F.lit(None).cast("string").alias(c) for c in (
        "cloud_provider account_id resource_group asset_name asset_type environment criticality owner_team"
        " provisioning_state sku_name sku_tier native_resource_id").split()]
    rows = table(spark, sf, "orders").select(
        F.concat(F.lit("O"), e.text("o_orderkey")).alias("asset_sk"), e.text("o_custkey").alias("asset_nk"),
        F.col("o_orderstatus").alias("region"), F.col("o_orderdate").alias("first_seen_at"), F.col("o_orderdate").alias("last_seen_at"), *blank,
    )
    return gold.dim_asset(rows, e.RUN_TS).select("asset_sk", "asset_nk", "region", F.date_format("first_seen_at", "yyyy-MM-dd").alias("first_seen"))


@query("build_dim_technology", "SELECT *, FALSE AS is_deprecated_stub, '1998-01-01 00:00:00' AS loaded_at FROM dim_tech")
def build_dim_technology(spark, sf):
    return stamped(e.dim_technology(spark, sf), "loaded_at")


@query("build_fact_inventory", "SELECT * FROM inventory")
def build_fact_inventory(spark, sf):
    return e.inventory(spark, sf)


@query(
    "build_match",
    """
    SELECT DISTINCT a.asset_sk, n.deprecation_sk, t.technology_family, t.runtime_name, t.runtime_version,
           strftime(n.retirement_at, '%Y-%m-%d') AS retirement, n.severity, n.status_norm AS status
    FROM event n JOIN sparse_tech t ON lower(n.technology_family) = lower(t.technology_family)
     AND (n.affected_runtime IS NULL OR trim(n.affected_runtime) = '' OR lower(n.affected_runtime) = lower(t.runtime_name))
     AND (n.affected_version IS NULL OR trim(n.affected_version) = '' OR lower(n.affected_version) = lower(t.runtime_version))
    JOIN asset a ON a.native_resource_id = t.resource_id
    """,
)
def build_match(spark, sf):
    ev = e.events(spark, sf)
    # The date is written once per notice, not once per match.
    dated = ev.withColumn("retirement_at", F.date_format("retirement_at", "yyyy-MM-dd"))
    rows = gold.matched_assets(ev, e.sparse_technology(spark, sf), e.assets(spark, sf), dated)
    return rows.withColumnRenamed("retirement_at", "retirement")


@query("build_fact_impact", "SELECT * FROM impact")
def build_fact_impact(spark, sf):
    return e.impact(spark, sf)


@query(
    "date_spine",
    """
    WITH span AS (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY))::DATE AS d FROM orders),
    per_day AS (SELECT o_orderdate::DATE AS d, count(*) AS n FROM orders GROUP BY 1)
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, strftime(d, '%Y-%m-%d') AS full_date, year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter,
           month(d)::INTEGER AS month, week(d)::INTEGER AS week, day(d)::INTEGER AS day, (isodow(d) - 1)::INTEGER AS day_of_week, dayname(d) AS day_name,
           monthname(d) AS month_name, isodow(d) >= 6 AS is_weekend, coalesce(n, 0) AS orders_placed
    FROM span LEFT JOIN per_day USING (d)
    """,
)
def date_spine(spark, sf):
    o = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    bounds = o.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    calendar = reference.calendar_attributes(reference.days_between(bounds))
    per_day = o.groupBy(F.date_format("day", "yyyy-MM-dd").alias("full_date")).agg(F.count(F.lit(1)).alias("n"))
    return calendar.join(per_day, "full_date", "left").withColumn("orders_placed", F.coalesce("n", F.lit(0))).drop("n")


@query(
    "seed_dimension",
    """
    SELECT environment_sk, environment_name, is_production, description, count(asset_sk) AS total_assets
    FROM (VALUES ('1', 'production', TRUE, 'Ambiente productivo'), ('2', 'staging', FALSE, 'Pre-productivo / UAT'), ('3', 'testing', FALSE, 'Ambiente de pruebas'),
                 ('4', 'development', FALSE, 'Desarrollo'), ('5', 'unknown', FALSE, 'Sin clasificar')) v(environment_sk, environment_name, is_production, description)
    LEFT JOIN asset ON environment = environment_name GROUP BY ALL
    """,
)
def seed_dimension(spark, sf):
    counts = e.assets(spark, sf).groupBy(F.col("environment").alias("environment_name")).agg(F.count(F.lit(1)).alias("n"))
    seeds = reference.dim_environment(spark).join(counts, "environment_name", "left")
    return seeds.withColumn("total_assets", F.coalesce("n", F.lit(0))).drop("n")
