"""Derived columns and row-level projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from duskline.functions import keys, normalize, risk, text as rules
from duskline.operators.tags import explode_tags, tag_map
from duskline.plans import bronze, feed, gold, model
from duskline.queries import entities as e
from duskline.queries.registry import cte, query, table
from duskline.sources import landing

# -- landed resources composed from part ------------------------------------------
cte(
    "resource",
    """
    SELECT 'R' || p_partkey AS resource_id, p_name AS resource_name, lower('Vendor.' || p_type || '/sites') AS resource_type,
           'sub-' || (p_size % 9) AS subscription_id, p_brand AS resource_group,
           CASE p_size % 4 WHEN 0 THEN 'eastus' WHEN 1 THEN 'UKSouth' WHEN 2 THEN 'westeurope' ELSE 'marsnorth' END AS location,
           p_type AS kind, p_type AS sku_name, CASE WHEN p_size > 10 THEN p_brand END AS sku_tier,
           CASE WHEN p_size % 3 = 0 THEN 'Failed' ELSE 'Succeeded' END AS provisioning_state,
           CASE p_type WHEN 'PROMO' THEN 'PYTHON|3.' || p_size WHEN 'LARGE' THEN 'DOTNETCORE' WHEN 'SMALL' THEN '' END AS linux_fx,
           CASE WHEN p_type = 'ECONOMY' THEN '1.' || p_size END AS k8s_declared,
           CASE WHEN p_type = 'ECONOMY' AND p_size > 20 THEN '1.' || (p_size + 1) END AS k8s_current,
           CASE WHEN p_type = 'MEDIUM' THEN CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END END AS rbac,
           CASE WHEN p_type = 'STANDARD' THEN 'Linux' END AS os_type, CASE WHEN p_type = 'STANDARD' THEN p_brand END AS image_sku,
           CASE WHEN p_size = 7 THEN 'TLS1_2' END AS min_tls,
           p_name AS tag_owner, CASE WHEN p_size % 2 = 0 THEN 'Prod ' END AS tag_env
    FROM part
    """,
)


def landed_resources(spark, sf):
    """Landed resource rows with nested properties as JSON text, one per part."""
    size, kind = F.col("p_size"), F.col("p_type")
    when = lambda test, value: F.when(test, value)
    runtime = e.case((kind == "PROMO", F.concat(F.lit("PYTHON|3."), e.text(size))), (kind == "LARGE", "DOTNETCORE"), (kind == "SMALL", ""))
    economy = kind == "ECONOMY"
    properties = F.struct(
        F.when(size % 3 == 0, "Failed").otherwise("Succeeded").alias("provisioningState"),
        F.struct(runtime.alias("linuxFxVersion")).alias("siteConfig"),
        when(economy, F.concat(F.lit("1."), e.text(size))).alias("kubernetesVersion"),
        when(economy & (size > 20), F.concat(F.lit("1."), e.text(size + 1))).alias("currentKubernetesVersion"),
        when(kind == "MEDIUM", size > 25).alias("enableRbacAuthorization"),
        F.struct(
            F.struct(when(kind == "STANDARD", "Linux").alias("osType")).alias("osDisk"),
            F.struct(when(kind == "STANDARD", F.col("p_brand")).alias("sku")).alias("imageReference"),
        ).alias("storageProfile"),
        when(size == 7, "TLS1_2").alias("minimumTlsVersion"),
        F.lit("1").alias("creationDate"),
    )
    tags = F.map_from_arrays(
        F.array_compact(F.array(F.lit("Owner"), when(size % 2 == 0, "ENV"))),
        F.array_compact(F.array(F.col("p_name"), when(size % 2 == 0, "Prod "))),
    )
    return table(spark, sf, "part").select(
        F.concat(F.lit("R"), e.text("p_partkey")).alias("id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("Vendor."), kind, F.lit("/sites")).alias("type"),
        F.concat(F.lit("sub-"), e.text(size % 9)).alias("subscription_id"),
        F.col("p_brand").alias("resource_group"),
        e.case((size % 4 == 0, "eastus"), (size % 4 == 1, "UKSouth"), (size % 4 == 2, "westeurope"), default="marsnorth").alias("location"),
        kind.alias("kind"),
        F.struct(kind.alias("name"), when(size > 10, F.col("p_brand")).alias("tier")).alias("sku"),
        tags.alias("tags"),
        F.to_json(properties).alias("properties"),
    )


def loaded_resources(spark, sf):
    return bronze.bronze_metadata(landed_resources(spark, sf), e.RUN_TS, source_path="landing/resources.json")


# -- raw layer ------------------------------------------------------------------------
@query(
    "bronze_metadata",
    """
    SELECT resource_id, 'duskline' AS source_system, 'azure' AS cloud_provider, '1998-01-01 00:00:00' AS collected_at,
           'landing/resources.json' AS source_path, 64 AS id_length, resource_name AS payload_name, kind AS payload_sku
    FROM resource
    """,
)
def bronze_metadata(spark, sf):
    df = loaded_resources(spark, sf)
    return df.select(
        F.col("id").alias("resource_id"), "source_system", "cloud_provider", e.ts_text("collected_at").alias("collected_at"),
        "source_path", F.length("ingestion_id").alias("id_length"),
        F.get_json_object("raw_payload", "$.name").alias("payload_name"),
        F.get_json_object("raw_payload", "$.sku.name").alias("payload_sku"),
    )


_FLAT_NULLS = [
    c for c in bronze.PROPERTY_PATHS
    if c not in {
        "provisioning_state", "runtime_linux_fx_version", "aks_kubernetes_version", "aks_kubernetes_version_current",
        "kv_rbac_enabled", "vm_os_type", "vm_image_sku", "storage_minimum_tls_version",
    }
]


@query(
    "flatten_resource",
    f"""
    SELECT resource_id, resource_name, resource_type, subscription_id, resource_group, location, kind, sku_name, sku_tier,
           CASE WHEN tag_env IS NULL THEN '{{"Owner":"' || tag_owner || '"}}'
                ELSE '{{"Owner":"' || tag_owner || '","ENV":"' || tag_env || '"}}' END AS tags_json,
           provisioning_state, linux_fx AS runtime_linux_fx_version, k8s_declared AS aks_kubernetes_version,
           k8s_current AS aks_kubernetes_version_current, rbac AS kv_rbac_enabled, os_type AS vm_os_type,
           image_sku AS vm_image_sku, min_tls AS storage_minimum_tls_version,
           'landing/resources.json' AS source_path, '1998-01-01 00:00:00' AS collected_at,
           TRUE AS properties_kept, {', '.join(f'CAST(NULL AS VARCHAR) AS {c}' for c in _FLAT_NULLS)}
    FROM resource
    """,
)
def flatten_resource(spark, sf):
    flat = bronze.flatten_resource(loaded_resources(spark, sf))
    return flat.withColumn("collected_at", e.ts_text("collected_at")).withColumn(
        "properties_kept", F.get_json_object("properties_json", "$.creationDate") == "1"
    ).drop("properties_json")


@query(
    "tag_explode",
    """
    SELECT resource_id, subscription_id, 'Owner' AS tag_key, tag_owner AS tag_value FROM resource
    UNION ALL
    SELECT resource_id, subscription_id, 'ENV', tag_env FROM resource WHERE tag_env IS NOT NULL
    """,
)
def tag_explode(spark, sf):
    return bronze.resource_tags(loaded_resources(spark, sf)).select("resource_id", "subscription_id", "tag_key", "tag_value")


@query(
    "tag_explode_json",
    "SELECT event_id, 'k' AS tag_key, json_extract_string(props, '$.k') AS tag_value FROM events",
)
def tag_explode_json(spark, sf):
    ev = table(spark, sf, "events")
    return explode_tags(ev, tag_map("props", json_text=True), ["event_id"])


@query(
    "account_extract",
    """
    SELECT DISTINCT subscription_id, 'duskline' AS source_system, 'azure' AS cloud_provider,
           'azure_subscription' AS account_type, '1998-01-01 00:00:00' AS collected_at
    FROM resource
    """,
)
def account_extract(spark, sf):
    accounts = bronze.cloud_accounts(landed_resources(spark, sf), e.RUN_TS)
    return accounts.select(
        "subscription_id", "source_system", "cloud_provider", "account_type", e.ts_text("collected_at").alias("collected_at")
    )


# -- landed notices composed from orders ------------------------------------------------
cte(
    "landed_notice",
    """
    SELECT CASE WHEN o_totalprice < 20000 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS created,
           'Retirement of ' || CASE o_custkey % 7 WHEN 0 THEN 'AKS' WHEN 1 THEN 'Web App' WHEN 2 THEN 'Cosmos' WHEN 3 THEN 'Blob'
               WHEN 4 THEN 'Key Vault' WHEN 5 THEN 'DNS' ELSE 'queue' END || ' ' || o_orderpriority || ' by customer ' || o_custkey AS title,
           o_orderstatus AS status,
           CASE WHEN o_totalprice < 450000 THEN strftime(o_orderdate + INTERVAL 200 DAY, '%Y-%m-%d') END AS retire_date,
           CASE WHEN o_totalprice < 450000 THEN CAST(year(o_orderdate + INTERVAL 200 DAY) AS BIGINT) END AS retire_year,
           'landing/' || o_orderstatus || '.json' AS source_path
    FROM orders
    """,
)


def landed_notices(spark, sf):
    later = F.col("o_orderdate") + F.expr("INTERVAL 200 DAY")
    dated = F.col("o_totalprice") < 450000
    k = F.col("o_custkey") % 7
    subject = e.case((k == 0, "AKS"), (k == 1, "Web App"), (k == 2, "Cosmos"), (k == 3, "Blob"), (k == 4, "Key Vault"), (k == 5, "DNS"), default="queue")
    return table(spark, sf, "orders").select(
        F.when(F.col("o_totalprice") < 20000, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("created"),
        F.concat(F.lit("Retirement of "), subject, F.lit(" "), "o_orderpriority", F.lit(" by customer "), e.text("o_custkey")).alias("title"),
        F.col("o_orderstatus").alias("status"),
        F.when(dated, F.date_format(later, "yyyy-MM-dd")).alias("retire_date"),
        F.when(dated, F.year(later).cast("long")).alias("retire_year"),
        F.concat(F.lit("landing/"), "o_orderstatus", F.lit(".json")).alias("source_path"),
    )


@query(
    "notice_bronze",
    """
    SELECT 'duskline' AS source_system, 'azure' AS cloud_provider, 'microsoft' AS vendor,
           sha256('microsoft|' || created || '|' || title) AS notice_id, title, CAST(NULL AS VARCHAR) AS summary,
           'azure.release_communications' AS affected_service, CAST(NULL AS VARCHAR) AS affected_feature,
           CAST(NULL AS VARCHAR) AS affected_runtime, CAST(NULL AS VARCHAR) AS affected_version,
           retire_date || ' 00:00:00' AS retirement_at,
           CASE WHEN created <> '' THEN created || ' 00:00:00' END AS published_at,
           CAST(NULL AS VARCHAR) AS severity, status, retire_date, retire_year,
           '1998-01-01 00:00:00' AS collected_at, source_path, title AS payload_title
    FROM landed_notice
    """,
)
def notice_bronze(spark, sf):
    df = bronze.notice_bronze(landed_notices(spark, sf), e.RUN_TS)
    for c in ("retirement_at", "published_at", "collected_at"):
        df = df.withColumn(c, e.ts_text(c))
    return df.withColumn("payload_title", F.get_json_object("raw_payload", "$.title")).drop("ingestion_id", "raw_payload")


@query(
    "canonical_row",
    """
    SELECT 'R' || p_partkey AS id, p_name AS name, coalesce(CASE WHEN p_size > 5 THEN p_type END, '') AS type,
           CASE WHEN p_size % 3 = 0 THEN 'sub-default' WHEN p_size % 3 = 1 THEN 'sub-default' ELSE p_brand END AS subscription_id,
           p_type AS resource_group
    FROM part
    """,
)
def canonical_row(spark, sf):
    size = F.col("p_size")
    raw = table(spark, sf, "part").select(
        F.concat(F.lit("R"), e.text("p_partkey")).alias("id"),
        F.col("p_name").alias("name"),
        F.when(size > 5, F.col("p_type")).alias("type"),
        F.col("p_type").alias("resourceGroup"),
        F.lit(None).cast("string").alias("location"),
        e.case((size % 3 == 0, F.lit("")), (size % 3 == 1, F.lit(None)), default=F.col("p_brand")).alias("subscriptionId"),
        *[F.lit(None).cast("string").alias(c) for c in ("kind", "sku", "tags", "properties")],
    )
    return landing.canonical_resource(raw, "sub-default").select("id", "name", "type", "subscription_id", "resource_group")


@query(
    "source_projection",
    """
    SELECT CAST(event_id AS VARCHAR) AS id, event_type AS impacted_type, 'user-' || user_id AS impacted_resource_id,
           CAST(json_extract(props, '$.k') AS VARCHAR) AS problem, 'sub-' || user_id AS subscription_id
    FROM events
    """,
)
def source_projection(spark, sf):
    user = e.text("user_id")
    raw = table(spark, sf, "events").select(
        e.text("event_id").alias("id"),
        F.lit("vendor.advisor/recommendations").alias("type"),
        F.concat(F.lit("sub-"), user).alias("subscriptionId"),
        F.struct(
            F.lit("HighAvailability").alias("category"),
            F.struct(F.concat(F.lit("user-"), user).alias("resourceId")).alias("resourceMetadata"),
            F.col("event_type").alias("impactedField"),
            F.struct(F.get_json_object("props", "$.k").alias("problem"), F.lit("x").alias("solution")).alias("shortDescription"),
            F.lit(None).cast("string").alias("lastUpdated"),
            F.lit(None).cast("string").alias("recommendationTypeId"),
        ).alias("properties"),
    )
    rows = landing.canonical_recommendation(landing.project_recommendation(raw))
    return rows.select("id", "impacted_type", "impacted_resource_id", "problem", "subscription_id")


# -- normalisation ----------------------------------------------------------------------
@query(
    "normalize_region",
    """
    SELECT resource_id, CASE lower(location) WHEN 'eastus' THEN 'East US' WHEN 'uksouth' THEN 'UK South'
           WHEN 'westeurope' THEN 'West Europe' ELSE location END AS region
    FROM resource
    """,
)
def normalize_region(spark, sf):
    df = landed_resources(spark, sf)
    return df.select(F.col("id").alias("resource_id"), normalize.region_name("location").alias("region"))


ENV_SQL = """CASE WHEN lower({c}) LIKE '%prod%' THEN 'production' WHEN lower({c}) LIKE '%dev%' THEN 'development'
    WHEN lower({c}) LIKE '%test%' THEN 'testing' WHEN lower({c}) LIKE '%stg%' THEN 'staging'
    WHEN lower({c}) LIKE '%staging%' THEN 'staging' ELSE 'unknown' END"""


@query("normalize_account_env", f"SELECT doc_id, {ENV_SQL.format(c='text')} AS environment FROM documents")
def normalize_account_env(spark, sf):
    return table(spark, sf, "documents").select("doc_id", normalize.account_environment("text").alias("environment"))


@query(
    "natural_key",
    """
    SELECT resource_id, 'azure|' || subscription_id || '|' || resource_type || '|' || lower(trim(resource_name)) AS asset_nk,
           'azure|' || subscription_id || '|' || lower(resource_group) || '|' || resource_type || '|' || lower(trim(resource_name)) AS asset_nk_group
    FROM resource
    """,
)
def natural_key(spark, sf):
    parts = (F.lit("azure"), "subscription_id", "type", "name")
    return landed_resources(spark, sf).select(
        F.col("id").alias("resource_id"),
        keys.asset_key(*parts).alias("asset_nk"),
        keys.asset_key(*parts, resource_group="resource_group").alias("asset_nk_group"),
    )


@query(
    "coalesce_tags",
    """
    SELECT event_id, lower(trim(coalesce(CASE WHEN value > 5 THEN event_type END, CASE WHEN value > 3 THEN ' ' || props || ' ' END, 'unknown'))) AS label
    FROM events
    """,
)
def coalesce_tags(spark, sf):
    first = F.when(F.col("value") > 5, F.col("event_type"))
    second = F.when(F.col("value") > 3, F.concat(F.lit(" "), "props", F.lit(" ")))
    return table(spark, sf, "events").select("event_id", normalize.tag_label(first, second).alias("label"))


@query(
    "split_runtime",
    """
    SELECT p_partkey, lower(p_brand) AS runtime_name, CASE WHEN p_size > 10 THEN p_type END AS runtime_version FROM part
    """,
)
def split_runtime(spark, sf):
    joined = F.when(F.col("p_size") > 10, F.concat_ws("|", "p_brand", "p_type")).otherwise(F.col("p_brand"))
    name, version = normalize.runtime_parts(joined)
    return table(spark, sf, "part").select("p_partkey", name.alias("runtime_name"), version.alias("runtime_version"))


@query(
    "timestamp_coalesce",
    """
    SELECT o_orderkey, strftime(CASE WHEN o_totalprice > 300000 THEN o_orderdate
        WHEN o_totalprice > 100000 THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) END, '%Y-%m-%d %H:%M:%S') AS at
    FROM orders
    """,
)
def timestamp_coalesce(spark, sf):
    price = F.col("o_totalprice")
    first = F.when(price > 300000, e.ts_text("o_orderdate")).otherwise("")
    second = F.when(price > 100000, F.date_format(F.date_add("o_orderdate", 1), "yyyy-MM-dd")).otherwise("soon")
    return table(spark, sf, "orders").select("o_orderkey", e.ts_text(normalize.first_timestamp(first, second)).alias("at"))


# -- text rules -------------------------------------------------------------------------
@query("normalize_status", f"SELECT deprecation_sk, {e.STATUS_SQL.format(c='status')} AS status FROM notice")
def normalize_status(spark, sf):
    return e.notices(spark, sf).select("deprecation_sk", rules.status_label("status").alias("status"))


@query("normalize_status_text", f"SELECT doc_id, md5({e.STATUS_SQL.format(c='text')}) AS status_md5 FROM documents")
def normalize_status_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(rules.status_label("text")).alias("status_md5"))


_FAMILY_TEXT = "lower(concat_ws(' ', lang, source, text))"
_FAMILY_SQL = "CASE " + " ".join(
    f"WHEN regexp_matches({{h}}, '{p}') THEN '{label}'" for label, p in (
        ("containers", "aks|kubernetes|container"), ("compute", "function|app service|web app|vm|virtual machine"),
        ("data", "sql|mysql|postgres|cosmos|database"), ("storage", "storage|blob|files"),
        ("security", "key vault|identity|entra|aad"), ("network", "network|gateway|load balancer|dns"),
    )
) + " ELSE 'platform' END"


@query(
    "classify_family",
    f"SELECT doc_id, {_FAMILY_SQL.format(h=_FAMILY_TEXT)} AS technology_family FROM documents",
)
def classify_family(spark, sf):
    return table(spark, sf, "documents").select("doc_id", rules.technology_family("lang", "source", "text").alias("technology_family"))


@query(
    "impact_scope",
    """
    SELECT deprecation_sk, CASE WHEN trim(coalesce(affected_runtime, '')) <> '' THEN 'runtime'
        WHEN trim(coalesce(affected_feature, '')) <> '' THEN 'feature' WHEN trim(coalesce(affected_version, '')) <> '' THEN 'runtime'
        WHEN trim(coalesce(affected_service, '')) <> '' THEN 'service' ELSE 'configuration' END AS impact_scope
    FROM notice
    """,
)
def impact_scope(spark, sf):
    scope = rules.impact_scope("affected_service", "affected_feature", "affected_runtime", "affected_version")
    return e.notices(spark, sf).select("deprecation_sk", scope.alias("impact_scope"))


@query(
    "classify_notice",
    """
    SELECT page_id, CASE WHEN t LIKE '%key vault%' THEN 'azure.key_vault'
        WHEN t LIKE '%python%' AND t LIKE '%function%' THEN 'azure.functions.python' ELSE 'unclassified' END AS notice_class
    FROM (SELECT page_id, lower(url || ' ' || html || CASE WHEN page_id % 3 = 0 THEN ' Python code' WHEN page_id % 3 = 1 THEN ' Key Vault' ELSE '' END) AS t FROM pages)
    """,
)
def classify_notice(spark, sf):
    k = F.col("page_id") % 3
    body = F.concat("html", e.case((k == 0, " Python code"), (k == 1, " Key Vault"), default=""))
    return table(spark, sf, "pages").select("page_id", rules.notice_class("url", body).alias("notice_class"))


# Dates written in both orders around the text of each order row.
cte(
    "dated_text",
    """
    SELECT o_orderkey, o_orderdate, CASE o_orderkey % 6
        WHEN 0 THEN o_orderpriority || ': will retire on ' || strftime(o_orderdate, '%-d %B %Y') || ', then ' || strftime(o_orderdate + INTERVAL 40 DAY, '%B %-d, %Y')
        WHEN 1 THEN 'By ' || strftime(o_orderdate, '%B') || ' ' || day(o_orderdate) || 'th, ' || year(o_orderdate) || ' or 3 may 2031'
        WHEN 2 THEN 'Retiring ' || strftime(o_orderdate, '%-d') || 'st ' || upper(strftime(o_orderdate, '%B')) || ' ' || year(o_orderdate) || '.'
        WHEN 3 THEN 'On 30 February ' || year(o_orderdate) || ' and 1 May ' || year(o_orderdate)
        WHEN 4 THEN 'On 31 June ' || year(o_orderdate) || ', or ' || strftime(o_orderdate, '%B %-d %Y')
        ELSE o_orderpriority || ' is retiring in ' || year(o_orderdate) END AS text
    FROM orders
    """,
)
_MONTHS_SQL = "january|february|march|april|may|june|july|august|september|october|november|december"
_DATE_SQL = f"""
    SELECT {{key}}, CASE WHEN d1 IS NULL THEN d2 WHEN d2 IS NULL THEN d1 WHEN strpos(text, m1) < strpos(text, m2) THEN d1 ELSE d2 END AS day
    FROM (SELECT *,
            CAST(try_strptime(regexp_extract(m1, '^([0-9]+)', 1) || ' ' || regexp_extract(m1, '({_MONTHS_SQL})', 1, 'i') || ' ' || right(m1, 4), '%d %B %Y') AS DATE) AS d1,
            CAST(try_strptime(regexp_extract(m2, '([0-9]+)(st|nd|rd|th)?,?\\s+[0-9]+$', 1, 'i') || ' ' || regexp_extract(m2, '({_MONTHS_SQL})', 1, 'i') || ' ' || right(m2, 4), '%d %B %Y') AS DATE) AS d2
        FROM (SELECT *, regexp_extract(text, '\\b[0-9]{{{{1,2}}}}(st|nd|rd|th)?\\s+({_MONTHS_SQL})\\s+[0-9]{{{{4}}}}\\b', 0, 'i') AS m1,
                     regexp_extract(text, '\\b({_MONTHS_SQL})\\s+[0-9]{{{{1,2}}}}(st|nd|rd|th)?,?\\s+[0-9]{{{{4}}}}\\b', 0, 'i') AS m2
              FROM {{source}}))
"""


def dated_text(spark, sf):
    k, at = F.col("o_orderkey") % 6, F.col("o_orderdate")
    part = lambda fmt, d=at: F.date_format(d, fmt)
    c = F.concat
    body = e.case(
        (k == 0, c("o_orderpriority", F.lit(": will retire on "), part("d MMMM yyyy"), F.lit(", then "), part("MMMM d, yyyy", at + F.expr("INTERVAL 40 DAY")))),
        (k == 1, c(F.lit("By "), part("MMMM d"), F.lit("th, "), part("yyyy"), F.lit(" or 3 may 2031"))),
        (k == 2, c(F.lit("Retiring "), part("d"), F.lit("st "), F.upper(part("MMMM")), F.lit(" "), part("yyyy"), F.lit("."))),
        (k == 3, c(F.lit("On 30 February "), part("yyyy"), F.lit(" and 1 May "), part("yyyy"))),
        (k == 4, c(F.lit("On 31 June "), part("yyyy"), F.lit(", or "), part("MMMM d yyyy"))),
        default=c("o_orderpriority", F.lit(" is retiring in "), part("yyyy")),
    )
    return table(spark, sf, "orders").select("o_orderkey", "o_orderdate", body.alias("text"))


@query(
    "extract_retire_date",
    f"SELECT o_orderkey, strftime(day, '%Y-%m-%d') AS retire_date FROM ({_DATE_SQL.format(key='o_orderkey', source='dated_text')})",
)
def extract_retire_date(spark, sf):
    return dated_text(spark, sf).select("o_orderkey", F.date_format(rules.retire_date("text"), "yyyy-MM-dd").alias("retire_date"))


@query(
    "extract_retire_date_documents",
    f"SELECT doc_id, strftime(day, '%Y-%m-%d') AS retire_date FROM ({_DATE_SQL.format(key='doc_id', source='documents')})",
)
def extract_retire_date_documents(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.date_format(rules.retire_date("text"), "yyyy-MM-dd").alias("retire_date"))


@query(
    "normalize_notice",
    f"""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS created, trim(text) AS title,
           strftime(day, '%Y-%m-%d') AS retire_date, CAST(year(day) AS BIGINT) AS retire_year
    FROM ({_DATE_SQL.format(key='o_orderkey, o_orderdate, text', source='dated_text')})
    """,
)
def normalize_notice(spark, sf):
    items = dated_text(spark, sf).select(
        "o_orderkey",
        F.concat(F.lit("  "), "text", F.lit(" ")).alias("title"),
        F.lit(None).cast("string").alias("description"),
        F.lit("x").alias("status"),
        F.concat(e.ts_text("o_orderdate"), F.lit("Z")).alias("created"),
    )
    return feed.normalize_notice(items, "o_orderkey").select("o_orderkey", "created", "title", "retire_date", "retire_year")


# -- keys ---------------------------------------------------------------------------------
@query("date_sk", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_sk FROM lineitem")
def date_sk(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", keys.date_sk("l_shipdate").alias("date_sk"))


@query(
    "technology_key",
    """
    SELECT deprecation_sk, nk AS technology_nk, sha256(nk) AS technology_sk
    FROM (SELECT deprecation_sk, coalesce(affected_service, 'na') || '|' || coalesce(affected_runtime, 'na') || '|' || coalesce(affected_version, 'na') AS nk FROM notice)
    """,
)
def technology_key(spark, sf):
    nk = keys.technology_key("affected_service", "affected_runtime", "affected_version")
    return e.notices(spark, sf).select("deprecation_sk", nk.alias("technology_nk"), keys.hash_key(nk).alias("technology_sk"))


@query(
    "technology_sk_fallback",
    """
    SELECT resource_id, CASE WHEN technology_source = 'catalog' THEN 'K' || resource_id
        ELSE sha256(concat(technology_family, '|', coalesce(runtime_name, ''), '|', coalesce(runtime_version, ''))) END AS technology_sk
    FROM sparse_tech
    """,
)
def technology_sk_fallback(spark, sf):
    known = F.when(F.col("technology_source") == "catalog", F.concat(F.lit("K"), "resource_id"))
    sk = keys.technology_sk(known, "technology_family", "runtime_name", "runtime_version")
    return e.sparse_technology(spark, sf).select("resource_id", sk.alias("technology_sk"))


# -- risk ------------------------------------------------------------------------------------
@query("days_to_retirement", f"SELECT l_orderkey, l_linenumber, l_partkey, {e.DAYS_SQL.format(c='l_shipdate')} AS days_to_retirement FROM lineitem")
def days_to_retirement(spark, sf):
    days = risk.days_to_retirement("l_shipdate", e.AS_OF)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", days.alias("days_to_retirement"))


cte(
    "dated_order",
    f"""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'retired' ELSE 'open' END AS status, o_orderpriority,
           CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE {e.DAYS_SQL.format(c='o_orderdate')} END AS days
    FROM orders
    """,
)


def dated_orders(spark, sf):
    days = risk.days_to_retirement("o_orderdate", e.AS_OF)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "retired").otherwise("open").alias("status"),
        "o_orderpriority",
        F.when(F.col("o_orderpriority") != "5-LOW", days).alias("days"),
    )


@query("severity", f"SELECT o_orderkey, {e.SEVERITY_SQL.format(s='status', d='days')} AS severity FROM dated_order")
def severity(spark, sf):
    return dated_orders(spark, sf).select("o_orderkey", risk.severity(F.col("status"), F.col("days")).alias("severity"))


_LEVEL_SQL = "CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'Critical' WHEN '2' THEN 'HIGH' WHEN '3' THEN 'medium' WHEN '4' THEN 'info' END"


def _level():
    n = F.substring("o_orderpriority", 1, 1)
    return e.case((n == "1", "Critical"), (n == "2", "HIGH"), (n == "3", "medium"), (n == "4", "info"))


@query("priority", f"SELECT o_orderkey, {e.PRIORITY_SQL.format(s='l')} AS priority FROM (SELECT o_orderkey, {_LEVEL_SQL} AS l FROM orders)")
def priority(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", risk.priority(_level()).alias("priority"))


_BANDED_SQL = f"""SELECT o_orderkey, {e.BAND_SQL.format(d='days', p='p')} AS risk_band_sk
    FROM (SELECT *, {e.PRIORITY_SQL.format(s='l')} AS p FROM (SELECT *, {_LEVEL_SQL} AS l FROM dated_order))"""


@query("risk_band", _BANDED_SQL)
def risk_band(spark, sf):
    df = dated_orders(spark, sf)
    return df.select("o_orderkey", risk.risk_band(F.col("days"), risk.priority(_level())).alias("risk_band_sk"))


@query("risk_score", f"SELECT o_orderkey, {e.SCORE_SQL.format(b='risk_band_sk')} AS risk_score FROM ({_BANDED_SQL})")
def risk_score(spark, sf):
    df = dated_orders(spark, sf)
    band = risk.risk_band(F.col("days"), risk.priority(_level()))
    return df.select("o_orderkey", risk.risk_score(band).alias("risk_score"))


@query(
    "snapshot_flags",
    """
    SELECT asset_sk, coalesce(provisioning_state = 'Succeeded', FALSE) AS is_active,
           coalesce(technology_count, 0) > 0 AS has_technology, CAST(coalesce(technology_count, 0) AS BIGINT) AS technology_count
    FROM asset LEFT JOIN rollup ON native_resource_id = resource_id
    """,
)
def snapshot_flags(spark, sf):
    from duskline.operators.rollups import join_counts, technology_rollup

    rows = join_counts(e.assets(spark, sf), technology_rollup(e.asset_technology(spark, sf)))
    return gold.snapshot_flags(rows).select("asset_sk", "is_active", "has_technology", "technology_count")


@query(
    "rename_model",
    f"""
    SELECT deprecation_sk, title AS "Titulo del Aviso", technology_family AS "Familia Tecnologica", affected_service AS "Servicio Afectado",
           affected_runtime AS "Runtime Afectado", affected_version AS "Version Afectada",
           strftime(published_at, '%Y-%m-%d %H:%M:%S') AS "Publicado", strftime(retirement_at, '%Y-%m-%d %H:%M:%S') AS "Fecha de Retiro",
           severity AS "Severidad", status_norm AS "Estado", 'microsoft' AS "Proveedor", deprecation_sk AS notice_id, 'service' AS "Alcance del Impacto"
    FROM event
    """,
)
def rename_model(spark, sf):
    ev = e.events(spark, sf).select(
        "*", F.col("title").alias("notice_title"), F.lit("microsoft").alias("vendor"),
        F.col("deprecation_sk").alias("notice_id"), F.lit("service").alias("impact_scope"),
    )
    for c in ("published_at", "retirement_at"):
        ev = ev.withColumn(c, e.ts_text(c))
    return model.notice_dimension(ev)
