"""Joins and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from duskline.operators import filters, matching, rollups, star
from duskline.operators.tags import pivot_tags
from duskline.operators.technology import detect_technology
from duskline.plans import bronze
from duskline.queries import entities as e
from duskline.queries.projections import loaded_resources
from duskline.queries.registry import query, table
from duskline.sources import reference


@query(
    "unprocessed_files",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def unprocessed_files(spark, sf):
    loaded = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return filters.unprocessed(table(spark, sf, "orders"), loaded, by="o_custkey").select("o_orderkey", "o_custkey")


@query(
    "rows_with_group_max",
    """
    SELECT event_id, user_id, strftime(max(ts) OVER (PARTITION BY user_id), '%Y-%m-%d %H:%M:%S') AS last_seen_at
    FROM events WHERE user_id IS NOT NULL
    """,
)
def rows_with_group_max(spark, sf):
    rows = star.rows_with_group_max(table(spark, sf, "events"), "user_id", "ts", "last_seen_at")
    return rows.select("event_id", "user_id", e.ts_text("last_seen_at").alias("last_seen_at"))


@query(
    "left_join_tags",
    """
    SELECT resource_id, resource_name, tag_owner AS owner, tag_env AS env FROM resource
    """,
)
def left_join_tags(spark, sf):
    loaded = loaded_resources(spark, sf)
    labels = pivot_tags(bronze.resource_tags(loaded), newest="collected_at")
    flat = bronze.flatten_resource(loaded)
    return flat.join(labels, "resource_id", "left").select("resource_id", "resource_name", "owner", "env")


@query(
    "assets_without_tech",
    "SELECT asset_sk FROM asset WHERE native_resource_id NOT IN (SELECT resource_id FROM asset_tech)",
)
def assets_without_tech(spark, sf):
    return star.without_technology(e.assets(spark, sf), e.asset_technology(spark, sf)).select("asset_sk")


@query(
    "left_join_counts",
    "SELECT asset_sk, technology_count FROM asset LEFT JOIN rollup ON native_resource_id = resource_id",
)
def left_join_counts(spark, sf):
    rollup = rollups.technology_rollup(e.asset_technology(spark, sf))
    return rollups.join_counts(e.assets(spark, sf), rollup).select("asset_sk", "technology_count")


_MATCH_SQL = """
    FROM notice n JOIN {tech} t ON lower(n.technology_family) = lower(t.technology_family)
     AND (n.affected_runtime IS NULL OR trim(n.affected_runtime) = '' OR lower(n.affected_runtime) = lower(t.runtime_name))
     AND (n.affected_version IS NULL OR trim(n.affected_version) = '' OR lower(n.affected_version) = lower(t.runtime_version))
"""


@query(
    "wildcard_match",
    f"SELECT n.deprecation_sk, t.resource_id, t.technology_family, t.runtime_name, t.runtime_version {_MATCH_SQL.format(tech='tech')}",
)
def wildcard_match(spark, sf):
    rows = matching.wildcard_match(e.notices(spark, sf), e.technology(spark, sf))
    return rows.select("deprecation_sk", "resource_id", *matching.TRIPLE)


@query(
    "wildcard_match_triples",
    f"SELECT DISTINCT n.deprecation_sk, t.technology_family, t.runtime_name, t.runtime_version {_MATCH_SQL.format(tech='sparse_tech')}",
)
def wildcard_match_triples(spark, sf):
    """The match on distinct technologies, the part that never grows with the assets."""
    notices = e.notices(spark, sf)
    triples = matching.triple_counts(e.sparse_technology(spark, sf))
    return matching.match_triples(notices, triples).select("deprecation_sk", *matching.TRIPLE)


@query(
    "match_to_asset",
    f"SELECT n.deprecation_sk, a.asset_sk, t.runtime_name {_MATCH_SQL.format(tech='tech')} JOIN asset a ON a.native_resource_id = t.resource_id",
)
def match_to_asset(spark, sf):
    known = matching.match_to_asset(e.technology(spark, sf), e.assets(spark, sf))
    return matching.wildcard_match(e.notices(spark, sf), known).select("deprecation_sk", "asset_sk", "runtime_name")


@query(
    "attach_event",
    """
    SELECT deprecation_sk, affected_version, CASE WHEN affected_service <> '' THEN strftime(retirement_at, '%Y-%m-%d') END AS retirement,
           CASE WHEN affected_service <> '' THEN severity END AS severity, CASE WHEN affected_service <> '' THEN status_norm END AS status
    FROM event
    """,
)
def attach_event(spark, sf):
    notices = e.notices(spark, sf).select("deprecation_sk", "affected_version")
    known = e.events(spark, sf).filter("affected_service <> ''")
    rows = matching.attach_event(notices, known)
    return rows.select(
        "deprecation_sk", "affected_version", F.date_format("retirement_at", "yyyy-MM-dd").alias("retirement"), "severity", "status"
    )


@query(
    "dim_lookup_ci",
    """
    SELECT resource_id, coalesce(dim_sk, sha256(concat(technology_family, '|', coalesce(runtime_name, ''), '|', coalesce(runtime_version, '')))) AS technology_sk
    FROM sparse_tech LEFT JOIN tech_lookup ON f = lower(technology_family) AND f <> 'brand#3' AND n IS NOT DISTINCT FROM lower(runtime_name)
      AND v IS NOT DISTINCT FROM lower(runtime_version)
    """,
)
def dim_lookup_ci(spark, sf):
    """One family is not in the dimension, so that the hash fallback of the lookup is used."""
    known = e.dim_technology(spark, sf).filter("technology_family <> 'Brand#3'")
    rows = matching.lookup_technology(e.sparse_technology(spark, sf), known)
    return rows.select("resource_id", "technology_sk")


@query(
    "asset_tech_left",
    """
    SELECT a.asset_sk, t.technology_family, t.runtime_name, t.runtime_version
    FROM asset a LEFT JOIN asset_tech t ON a.native_resource_id = t.resource_id
    """,
)
def asset_tech_left(spark, sf):
    tech = e.asset_technology(spark, sf).withColumnRenamed("resource_id", "native_resource_id")
    return e.assets(spark, sf).join(tech, "native_resource_id", "left").select("asset_sk", *matching.TRIPLE)


@query(
    "star_join",
    """
    SELECT i.asset_sk, CASE d.year WHEN 1998 THEN 19980101 ELSE 19971231 END AS date_sk, a.asset_name, CASE i.cloud_provider WHEN 'azure' THEN 'Microsoft Azure' WHEN 'aws' THEN 'Amazon Web Services'
             ELSE 'Google Cloud Platform' END AS provider,
           CASE i.environment WHEN 'production' THEN TRUE WHEN 'staging' THEN FALSE WHEN 'testing' THEN FALSE WHEN 'unknown' THEN FALSE END AS is_production,
           n.n_nationkey AS account_number, d.year
    FROM inventory i JOIN asset a USING (asset_sk) JOIN nation n ON n.n_name = i.account_nk, (VALUES (1998), (1997)) d(year)
    """,
)
def star_join(spark, sf):
    """Two snapshot days of the inventory fact against its five dimensions."""
    today = e.inventory(spark, sf)
    fact = today.unionByName(today.withColumn("date_sk", F.lit(19971231)))
    return star.star_join(
        fact,
        (e.assets(spark, sf), "asset_sk", "asset_sk", {"asset_name": "asset_name"}),
        (reference.dim_cloud_provider(spark), "cloud_provider", "provider_name", {"display_name": "provider"}),
        (reference.dim_environment(spark), "environment", "environment_name", {"is_production": "is_production"}),
        (table(spark, sf, "nation"), "account_nk", "n_name", {"n_nationkey": "account_number"}),
        (reference.dim_date(spark, e.AS_OF), "date_sk", "date_sk", {"year": "year"}),
    ).select("asset_sk", "date_sk", "asset_name", "provider", "is_production", "account_number", "year")


# -- set operations ---------------------------------------------------------------------------
_TECH_BRANCHES = """
    SELECT resource_id, 'app_runtime' AS technology_family, 'linux_fx_version' AS technology_source, lower(split_part(linux_fx, '|', 1)) AS runtime_name,
           CASE WHEN contains(linux_fx, '|') THEN split_part(linux_fx, '|', 2) END AS runtime_version, CAST(NULL AS VARCHAR) AS feature_flag
    FROM resource WHERE linux_fx <> ''
    UNION ALL SELECT resource_id, 'container_orchestration', 'kubernetes_version', 'kubernetes', coalesce(k8s_current, k8s_declared), NULL
    FROM resource WHERE k8s_declared IS NOT NULL
    UNION ALL SELECT resource_id, 'key_vault_config', 'rbac_authorization', 'rbac_authorization', NULL, rbac FROM resource WHERE rbac IS NOT NULL
    UNION ALL SELECT resource_id, 'virtual_machine', 'os_image', lower(os_type), image_sku, NULL FROM resource WHERE os_type IS NOT NULL
    UNION ALL SELECT resource_id, 'storage_config', 'tls_version', 'tls', min_tls, NULL FROM resource WHERE min_tls IS NOT NULL
"""


@query("union_frames", _TECH_BRANCHES)
def union_frames(spark, sf):
    found = detect_technology(bronze.flatten_resource(loaded_resources(spark, sf)))
    return found.drop("resource_type", "subscription_id", "resource_name")


@query(
    "page_union",
    """
    SELECT 'documents' AS origin, doc_id AS item_id, length(text) AS chars FROM documents
    UNION ALL SELECT 'pages', page_id, length(html) FROM pages UNION ALL SELECT 'benchmark', item_id, length(text) FROM benchmark
    """,
)
def page_union(spark, sf):
    parts = []
    for name, key, body in (("documents", "doc_id", "text"), ("pages", "page_id", "html"), ("benchmark", "item_id", "text")):
        parts.append(
            table(spark, sf, name).select(
                F.lit(name).alias("origin"), F.col(key).alias("item_id"), F.length(body).cast("long").alias("chars")
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts)
