"""Filters, windows, sorts and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from duskline.functions import text as rules
from duskline.operators import dedupe, filters, rollups
from duskline.plans import feed, kpis
from duskline.queries import entities as e
from duskline.queries.projections import dated_text, landed_notices
from duskline.queries.registry import query, table


# -- filters ------------------------------------------------------------------------------
def _units(spark, sf):
    c = table(spark, sf, "customer")
    state = F.when(F.col("c_mktsegment") == "BUILDING", "ENABLED").when(F.col("c_mktsegment") == "MACHINERY", "Enabled")
    return c.select(F.col("c_custkey").alias("subscription_id"), "c_nationkey", state.otherwise("Disabled").alias("state"))


@query("scope_filter", "SELECT c_custkey AS subscription_id FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def scope_filter(spark, sf):
    return filters.in_scope(_units(spark, sf)).select("subscription_id")


@query("scope_filter_listed", "SELECT c_custkey AS subscription_id FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def scope_filter_listed(spark, sf):
    wanted = table(spark, sf, "orders").filter("o_totalprice > 450000").select("o_custkey")
    return filters.in_scope(_units(spark, sf), ids=wanted).select("subscription_id")


@query("scope_filter_all", "SELECT c_custkey AS subscription_id FROM customer")
def scope_filter_all(spark, sf):
    return filters.in_scope(_units(spark, sf), include_disabled=True).select("subscription_id")


@query("tagged_items", "SELECT event_id FROM events WHERE event_type = 'error' AND user_id % 9 <> 0")
def tagged_items(spark, sf):
    tags = F.when(F.col("event_type") == "error", F.array(F.lit("Updates"), F.lit("Retirements")))
    tags = tags.when(F.col("event_type") == "click", F.array(F.lit("retirements")))
    ev = table(spark, sf, "events").withColumn("tags", F.when(F.col("user_id") % 9 != 0, tags))
    return ev.filter(rules.is_tagged("tags")).select("event_id")


@query("regex_text_filter", "SELECT doc_id FROM documents WHERE regexp_matches(coalesce(source, '') || ' ' || coalesce(text, ''), '(?i)(retir|the\\s+\\w+ing\\b)')")
def regex_text_filter(spark, sf):
    return table(spark, sf, "documents").filter(rules.text_matches(r"(retir|the\s+\w+ing\b)", "source", "text")).select("doc_id")


@query("regex_text_filter_open", "SELECT doc_id FROM documents")
def regex_text_filter_open(spark, sf):
    return table(spark, sf, "documents").filter(rules.text_matches("", "source", "text")).select("doc_id")


@query(
    "optional_date_filters",
    """
    SELECT created, title, retire_date FROM landed_notice
    WHERE (retire_date IS NULL OR retire_date >= '1998-01-01') AND retire_year >= 1999 AND retire_year = 2000
    """,
)
def optional_date_filters(spark, sf):
    kept = filters.retirement_window(landed_notices(spark, sf), e.AS_OF, upcoming_only=True, year=2000, since=1999)
    return kept.select("created", "title", "retire_date")


@query("upcoming_notices", "SELECT created, title, retire_date FROM landed_notice WHERE retire_date IS NULL OR retire_date >= '1998-01-01'")
def upcoming_notices(spark, sf):
    return filters.retirement_window(landed_notices(spark, sf), e.AS_OF, upcoming_only=True).select("created", "title", "retire_date")


@query(
    "term_filter",
    """
    SELECT o_orderkey FROM dated_text JOIN orders USING (o_orderkey)
    WHERE o_orderstatus = 'F' AND (regexp_matches(text, '(?i)\\b(retir|deprecat)') OR regexp_matches(o_orderpriority, '(?i)\\b(retir|deprecat)'))
    """,
)
def term_filter(spark, sf):
    kind = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("problem"),
        F.when(F.col("o_orderstatus") == "F", "Vendor.Advisor/Recommendations").otherwise("vendor.other").alias("type"),
    )
    rows = dated_text(spark, sf).withColumnRenamed("text", "solution").join(kind, "o_orderkey")
    return filters.retirement_recommendations(rows, "vendor.advisor/recommendations").select("o_orderkey")


@query("term_filter_documents", "SELECT doc_id, regexp_matches(text, '(?i)\\b(retir|deprecat)') AS about_retirement FROM documents")
def term_filter_documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", rules.mentions_retirement("text").alias("about_retirement"))


@query("term_filter_stem", "SELECT event_id, event_type = 'error' OR event_type = 'view' AS about_retirement FROM events")
def term_filter_stem(spark, sf):
    kind = F.col("event_type")
    problem = e.case((kind == "error", "Retirement of a service"), (kind == "click", "a soldier retires unretired"), default="none")
    problem = F.when(kind == "click", "unretired").otherwise(problem)
    solution = F.when(kind == "view", F.concat(F.lit("move off the DEPRECATED api "), "props"))
    return table(spark, sf, "events").select("event_id", rules.mentions_retirement(problem, solution).alias("about_retirement"))


@query(
    "term_filter_whole",
    r"""
    SELECT l_orderkey, l_linenumber, l_linenumber IN (1, 2) AS whole_term, l_linenumber IN (1, 2, 3, 4, 6) AS word_beginning
    FROM lineitem
    """,
)
def term_filter_whole(spark, sf):
    """A stem as a word of its own, however cut off, against a stem that begins a longer word."""
    n = F.col("l_linenumber")
    text = e.case(
        (n == 1, "to Retir, then move"), (n == 2, "(DEPRECAT)"), (n == 3, "it retires soon"), (n == 4, "Deprecated"), (n == 5, "unretir"), (n == 6, "retir_x")
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", rules.mentions_retirement(text, whole_term=True).alias("whole_term"),
        rules.mentions_retirement(text).alias("word_beginning"),
    )


@query("not_null_key", "SELECT o_orderkey FROM orders WHERE o_totalprice >= 100000")
def not_null_key(spark, sf):
    df = table(spark, sf, "orders").withColumn("notice_id", F.when(F.col("o_totalprice") >= 100000, F.col("o_orderkey")))
    return df.filter(F.col("notice_id").isNotNull()).select("o_orderkey")


@query("not_null_map", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events WHERE value >= 10")
def not_null_map(spark, sf):
    ev = table(spark, sf, "events")
    ev = ev.withColumn("tags", F.from_json(F.when(F.col("value") >= 10, F.col("props")), "map<string,string>"))
    return ev.filter(F.col("tags").isNotNull()).select("event_id", F.col("tags")["k"].alias("k"))


@query("any_not_null", "SELECT resource_id FROM sparse_tech WHERE runtime_name IS NOT NULL OR runtime_version IS NOT NULL")
def any_not_null(spark, sf):
    return filters.any_filled(e.sparse_technology(spark, sf), "runtime_name", "runtime_version").select("resource_id")


@query("isin_ci", "SELECT p_partkey FROM part WHERE lower(p_type) IN ('promo', 'economy')")
def isin_ci(spark, sf):
    return table(spark, sf, "part").filter(filters.isin_folded("p_type", ["Promo", "ECONOMY"])).select("p_partkey")


@query("having", "SELECT l_orderkey, l_suppkey, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def having(spark, sf):
    return dedupe.repeated_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_suppkey"])


@query("bool_filter", "SELECT asset_sk, has_technology FROM inventory WHERE is_active AND NOT has_technology")
def bool_filter(spark, sf):
    return e.inventory(spark, sf).filter("is_active").filter(~F.col("has_technology")).select("asset_sk", "has_technology")


@query(
    "slicer",
    "SELECT region, environment, count(*) AS row_count FROM asset WHERE environment IN ('production', 'testing') AND cloud_provider = 'azure' GROUP BY 1, 2",
)
def slicer(spark, sf):
    chosen = filters.sliced(e.assets(spark, sf), environment=["production", "testing"], cloud_provider="azure", region=None)
    return rollups.group_count(chosen, "region", "environment")


# -- windows: newest and oldest row per key -----------------------------------------------------
@query(
    "latest_notice",
    """
    SELECT o_custkey, o_orderpriority, o_orderkey, o_orderstatus FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority
        ORDER BY CASE WHEN o_totalprice > 50000 THEN o_orderdate END DESC NULLS LAST, o_orderdate DESC, o_orderkey DESC) = 1
    """,
)
def latest_notice(spark, sf):
    o = e.snapshots(spark, sf).withColumn("published_at", F.when(F.col("o_totalprice") > 50000, F.col("o_orderdate")))
    rows = dedupe.latest_per_key(o, ["o_custkey", "o_orderpriority"], ["published_at", "o_orderdate", "o_orderkey"])
    return rows.select("o_custkey", "o_orderpriority", "o_orderkey", "o_orderstatus")


@query(
    "latest_rn",
    """
    SELECT l_partkey, l_orderkey, l_linenumber, l_quantity, l_returnflag, strftime(l_shipdate, '%Y-%m-%d') AS last_ship FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC NULLS LAST, l_orderkey DESC, l_linenumber DESC) = 1
    """,
)
def latest_rn(spark, sf):
    rows = dedupe.latest_per_key(table(spark, sf, "lineitem"), ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber"])
    return rows.select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", F.date_format("l_shipdate", "yyyy-MM-dd").alias("last_ship")
    )


@query(
    "oldest_asset",
    """
    SELECT o_custkey, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate ASC NULLS LAST, o_orderkey ASC) = 1
    """,
)
def oldest_asset(spark, sf):
    order = [F.col("o_orderdate").asc_nulls_last(), F.col("o_orderkey").asc()]
    return dedupe.first_per_key(e.snapshots(spark, sf), ["o_custkey"], order).select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "ordered_dedupe",
    """
    SELECT user_id, event_type, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1
    """,
)
def ordered_dedupe(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    return dedupe.first_in_feed(ev, ["user_id", "event_type"], ["event_id"])


# -- sorts and limits (a limit here is the report itself) -----------------------------------------
@query(
    "topn_types",
    """
    SELECT p_brand, p_type, count(*) AS row_count FROM part WHERE p_type IS NOT NULL
    GROUP BY 1, 2 ORDER BY row_count DESC, p_brand, p_type LIMIT 15
    """,
)
def topn_types(spark, sf):
    return rollups.top_groups(table(spark, sf, "part"), "p_brand", "p_type", n=15)


@query(
    "latest_preview",
    "SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS published, o_orderstatus FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 50",
)
def latest_preview(spark, sf):
    rows = table(spark, sf, "orders").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(50)
    return rows.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("published"), "o_orderstatus")


@query(
    "nearest_retirement",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, {e.DAYS_SQL.format(c='l_shipdate')} AS days_to_retirement FROM lineitem
    ORDER BY days_to_retirement, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 100
    """,
)
def nearest_retirement(spark, sf):
    from duskline.functions.risk import days_to_retirement

    rows = table(spark, sf, "lineitem").withColumn("days_to_retirement", days_to_retirement("l_shipdate", e.AS_OF))
    rows = rows.orderBy("days_to_retirement", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").limit(100)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "days_to_retirement")


@query("retire_order", "SELECT retire_date, title, created FROM landed_notice ORDER BY coalesce(retire_date, '9999-12-31'), title")
def retire_order(spark, sf):
    return feed.by_retirement(landed_notices(spark, sf).select("retire_date", "title", "created"))


@query(
    "count_desc",
    "SELECT l_suppkey, count(*) AS row_count FROM lineitem GROUP BY 1 ORDER BY row_count DESC, l_suppkey LIMIT 20",
)
def count_desc(spark, sf):
    return kpis.largest(rollups.group_count(table(spark, sf, "lineitem"), "l_suppkey"), "row_count", "l_suppkey", n=20)


@query("visual_sort", "SELECT region, count(*) AS row_count FROM asset GROUP BY 1 ORDER BY row_count DESC, region")
def visual_sort(spark, sf):
    return kpis.largest(rollups.group_count(e.assets(spark, sf), "region"), "row_count", "region")


_TOP = "SELECT p_brand, count(*) AS row_count FROM part GROUP BY 1 ORDER BY row_count DESC, p_brand LIMIT 15"


@query("ascending_replot", f"SELECT * FROM ({_TOP}) ORDER BY row_count, p_brand")
def ascending_replot(spark, sf):
    return rollups.top_groups(table(spark, sf, "part"), "p_brand", n=15).orderBy("row_count", "p_brand")


@query("topn_total", f"SELECT CAST(sum(row_count) AS BIGINT) AS total FROM ({_TOP})")
def topn_total(spark, sf):
    return rollups.top_groups(table(spark, sf, "part"), "p_brand", n=15).agg(F.sum("row_count").alias("total"))


