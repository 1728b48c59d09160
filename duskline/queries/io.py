"""Sources and sinks: whole tables are landed or written in the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from duskline.functions.text import is_tagged
from duskline.operators.rollups import row_count
from duskline.plans import bronze, feed, runs
from duskline.queries import entities as e
from duskline.queries.projections import landed_notices, landed_resources
from duskline.queries.registry import query, table
from duskline.queries.tables import landed
from duskline.session import scratch, staged
from duskline.sinks import landing as landing_sink
from duskline.sinks.tables import TableStore
from duskline.sources import landing, reference, schemas
from duskline.streaming import incremental


def partition_value(name: str):
    """A folder value out of source_path."""
    return F.url_decode(F.regexp_extract("source_path", f"{name}=([^/]*)", 1))


def land_resources(spark, sf, label):
    root = scratch(spark, label)
    rows = landed_resources(spark, sf)
    rows = rows.withColumn("properties", F.from_json("properties", PROPERTY_STRUCT)).withColumn("run_id", F.col("subscription_id"))
    landing_sink.land_json(rows.withColumn("ingest_date", F.lit("1998-01-01")), root, ["ingest_date", "run_id"])
    return root


# Only the parts of the composed payload that are read back.
PROPERTY_STRUCT = (
    "provisioningState string, siteConfig struct<linuxFxVersion: string>, kubernetesVersion string,"
    " enableRbacAuthorization boolean, creationDate string"
)


@query(
    "json_snapshot_scan",
    """
    SELECT resource_id AS id, resource_name AS name, subscription_id, sku_name, sku_tier, tag_owner AS owner, provisioning_state,
           linux_fx, rbac, subscription_id AS run_id
    FROM resource
    """,
)
def json_snapshot_scan(spark, sf):
    rows = landing.read_snapshots(spark, land_resources(spark, sf, "snapshots"), multiline=False)
    path = lambda p: F.get_json_object("properties", f"$.{p}")
    return rows.select(
        "id", "name", "subscription_id", F.col("sku.name").alias("sku_name"), F.col("sku.tier").alias("sku_tier"),
        F.col("tags")["Owner"].alias("owner"), path("provisioningState").alias("provisioning_state"),
        path("siteConfig.linuxFxVersion").alias("linux_fx"), path("enableRbacAuthorization").alias("rbac"),
        partition_value("run_id").alias("run_id"),
    )


@query("payload_string_scan", "SELECT resource_id, kind, k8s_declared AS kubernetes_version, rbac FROM resource")
def payload_string_scan(spark, sf):
    rows = bronze.flatten_resource(
        bronze.bronze_metadata(landing.read_snapshots(spark, land_resources(spark, sf, "payload"), multiline=False), e.RUN_TS)
    )
    return rows.select("resource_id", "kind", F.col("aks_kubernetes_version").alias("kubernetes_version"), F.col("kv_rbac_enabled").alias("rbac"))


def land_notices(spark, sf, label):
    root = scratch(spark, label)
    rows = landed_notices(spark, sf).withColumn("ingest_date", F.col("status")).drop("source_path")
    landing_sink.land_json(rows, root, ["ingest_date"])
    return root


@query("json_notice_scan", "SELECT created, title, status, retire_date, retire_year, status AS ingest_date FROM landed_notice")
def json_notice_scan(spark, sf):
    rows = landing.read_notices(spark, land_notices(spark, sf, "notices"), multiline=False)
    return rows.withColumn("ingest_date", partition_value("ingest_date")).drop("source_path")


@query("source_lineage", "SELECT status AS ingest_date, count(*) AS row_count, TRUE AS has_path FROM landed_notice GROUP BY 1")
def source_lineage(spark, sf):
    rows = landing.read_notices(spark, land_notices(spark, sf, "lineage"), multiline=False)
    return rows.groupBy(partition_value("ingest_date").alias("ingest_date")).agg(
        row_count(), F.bool_and(F.col("source_path").isNotNull()).alias("has_path")
    )


@query("json_scan_one_run", "SELECT created, title, retire_date FROM landed_notice WHERE status = 'F'")
def json_scan_one_run(spark, sf):
    rows = landing.read_run(spark, land_notices(spark, sf, "one-run"), schemas.NOTICE, ingest_date="F")
    return rows.select("created", "title", "retire_date")


@query(
    "json_scan_schema",
    """
    SELECT CAST(event_id AS VARCHAR) AS id, 'sub-' || user_id AS subscription_id, event_type AS impacted_type, props AS problem,
           CAST(NULL AS VARCHAR) AS solution, CAST(NULL AS VARCHAR) AS category
    FROM events
    """,
)
def json_scan_schema(spark, sf):
    root = scratch(spark, "recommendations")
    user = F.concat(F.lit("sub-"), e.text("user_id"))
    rows = table(spark, sf, "events").select(
        e.text("event_id").alias("id"), user.alias("subscription_id"), F.col("event_type").alias("impacted_type"),
        F.col("props").alias("problem"), F.lit(None).cast("string").alias("solution"), F.col("event_type").alias("unit"),
    )
    landing_sink.land_json(rows, root, ["unit"])
    back = landing.read_recommendations(spark, root, multiline=False)
    return back.select("id", "subscription_id", "impacted_type", "problem", "solution", "category")


@query("table_scan", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem")
def table_scan(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    "table_exists",
    """
    SELECT 'orders' AS table_name, TRUE AS table_exists, count(*) AS row_count FROM orders
    UNION ALL SELECT 'customer', TRUE, count(*) FROM customer UNION ALL SELECT 'absent', FALSE, -1
    """,
)
def table_exists(spark, sf):
    return stored_counts(spark, sf, "exists").withColumn("table_exists", F.col("row_count") >= 0)


def stored_counts(spark, sf, label):
    store = TableStore(spark, scratch(spark, label))
    for name in ("orders", "customer"):
        store.overwrite(table(spark, sf, name), name)
    return store.row_counts(["orders", "customer", "absent"])


@query(
    "table_row_counts",
    "SELECT 'orders' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'absent', -1",
)
def table_row_counts(spark, sf):
    return stored_counts(spark, sf, "counts")


@query("dq_row_counts", "SELECT 'orders' AS table_name, count(*) AS row_count, 'OK' AS state FROM orders UNION ALL SELECT 'customer', count(*), 'OK' FROM customer UNION ALL SELECT 'absent', -1, 'ERROR'")
def dq_row_counts(spark, sf):
    return stored_counts(spark, sf, "dq").withColumn("state", F.when(F.col("row_count") >= 0, "OK").otherwise("ERROR"))


@query(
    "set_difference_tables",
    "SELECT 'absent' AS table_name, count(*) AS orders_present FROM orders",
)
def set_difference_tables(spark, sf):
    """Required tables that are missing, next to the size of one that is there."""
    store = TableStore(spark, scratch(spark, "required"))
    store.overwrite(table(spark, sf, "orders"), "orders")
    missing = store.missing(["orders", "absent"])
    present = store.read("orders").agg(row_count("orders_present"))
    return present.select(F.explode(F.lit(missing)).alias("table_name"), "orders_present")


@query(
    "empty_typed_table",
    "SELECT o_orderpriority AS priority, count(*) AS impacts, round(avg(0.5), 2)::DOUBLE AS risk FROM orders GROUP BY 1",
)
def empty_typed_table(spark, sf):
    """The fact is created empty once, filled, and not emptied by a second creation."""
    store = TableStore(spark, scratch(spark, "empty-fact"))
    store.create_if_missing(reference.empty_impacts(spark), "fact_deprecation_impact")
    rows = table(spark, sf, "orders").select(
        F.lit(19980101).alias("date_sk"), e.text("o_custkey").alias("asset_sk"), e.text("o_orderkey").alias("deprecation_sk"),
        F.lit(0.5).alias("risk_score"), F.col("o_orderpriority").alias("priority"),
    )
    store.append(reference.empty_impacts(spark).unionByName(rows, allowMissingColumns=True), "fact_deprecation_impact")
    store.create_if_missing(reference.empty_impacts(spark), "fact_deprecation_impact")
    fact = store.read("fact_deprecation_impact")
    return fact.groupBy("priority").agg(row_count("impacts"), F.avg("risk_score").alias("risk"))


@query(
    "page_envelope_explode",
    """
    SELECT CASE WHEN doc_id % 3 > 0 THEN doc_id END AS page_no, unnest(range(len(lines)))::INTEGER AS item_no, unnest(lines) AS title,
           source AS status, FALSE AS tagged
    FROM (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents)
    UNION ALL SELECT item_id, 0, text, 'later', FALSE FROM benchmark
    """,
)
def page_envelope_explode(spark, sf):
    """Documents are landed as response pages with their lines as items, a third without a page number, after an empty
    page and beside the pages of a later run; all items come back, in order."""
    root = scratch(spark, "pages")
    as_item = lambda line: F.struct(line.alias("title"), F.col("source").alias("status"))
    number = F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")).alias("page_no")
    lines = F.transform(F.split("text", r"\n"), as_item)
    docs = table(spark, sf, "documents")
    docs.select(number, lines.alias("value")).write.json(f"{root}/run_id=1")
    docs.select(F.col("doc_id").alias("page_no"), F.slice(lines, 1, 0).alias("value")).write.json(f"{root}/run_id=2")
    later = table(spark, sf, "benchmark").withColumn("source", F.lit("later"))
    later.select(F.col("item_id").alias("page_no"), F.array(as_item(F.col("text"))).alias("value")).write.json(f"{root}/run_id=3")
    items = landing.explode_pages(landing.read_feed_pages(spark, root, schemas.FEED_ITEM, multiline=False))
    return items.select("page_no", "item_no", "title", "status", is_tagged("tags").alias("tagged"))


@query(
    "load_new_files",
    "SELECT ingest_date, count(*) AS row_count, count(DISTINCT title) AS titles FROM (SELECT status AS ingest_date, title FROM landed_notice) GROUP BY 1",
)
def load_new_files(spark, sf):
    """Notices land in two steps and are loaded after each and once more: every file is loaded once."""
    root = scratch(spark, "new-files")
    store = TableStore(spark, f"{root}/tables")
    rows = landed_notices(spark, sf).withColumn("ingest_date", F.col("status")).drop("source_path")
    first = F.col("ingest_date") == "F"
    for part in (rows.filter(first), rows.filter(~first), rows.limit(0)):
        landing_sink.land_json(part, f"{root}/landing", ["ingest_date"])
        runs.load_notices(store, f"{root}/landing", e.RUN_TS, multiline=False)
    loaded = store.read("brz_deprecation_raw").withColumn("ingest_date", F.regexp_extract("source_path", "ingest_date=([^/]*)/", 1))
    return loaded.groupBy("ingest_date").agg(row_count(), F.count_distinct("title").alias("titles"))


# -- sinks -----------------------------------------------------------------------------------------
@query(
    "append_evolving",
    """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS added_later FROM orders
    """,
)
def append_evolving(spark, sf):
    store = TableStore(spark, scratch(spark, "append"))
    o = table(spark, sf, "orders")
    store.append(o.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey"), "raw")
    later = o.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("added_later"))
    store.append(later, "raw")
    return store.read("raw", evolving=True).select("o_orderkey", "o_custkey", "added_later")


@query("overwrite_table", "SELECT c_mktsegment, count(*) AS row_count FROM customer GROUP BY 1")
def overwrite_table(spark, sf):
    """The second version is computed from the first, which stays readable meanwhile."""
    store = TableStore(spark, scratch(spark, "overwrite"))
    store.overwrite(table(spark, sf, "customer"), "dim")
    store.overwrite(store.read("dim").groupBy("c_mktsegment").agg(row_count()), "dim")
    return store.read("dim")


def entity_batch(orders):
    """Newest order of each customer in a batch, with load columns."""
    newest = orders.groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus")).alias("r"))
    at = F.date_format("r.o_orderdate", "yyyy-MM-dd")
    return newest.select(
        F.col("o_custkey").alias("asset_nk"), "r.o_orderkey", "r.o_orderstatus", at.alias("first_seen_at"), at.alias("last_seen_at")
    )


@query(
    "upsert_by_key",
    """
    WITH b AS (SELECT o_custkey, o_orderdate < DATE '1998-01-01' AS early, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
                      arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus, strftime(max(o_orderdate), '%Y-%m-%d') AS at FROM orders GROUP BY 1, 2)
    SELECT o_custkey AS asset_nk, coalesce(l.o_orderkey, f.o_orderkey) AS o_orderkey, coalesce(l.o_orderstatus, f.o_orderstatus) AS o_orderstatus,
           coalesce(f.at, l.at) AS first_seen_at, coalesce(l.at, f.at) AS last_seen_at
    FROM (SELECT * FROM b WHERE early) f FULL JOIN (SELECT * FROM b WHERE NOT early) l USING (o_custkey)
    """,
)
def upsert_by_key(spark, sf):
    store = TableStore(spark, scratch(spark, "upsert"))
    o = table(spark, sf, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("date")
    for batch in (o.filter(early), o.filter(~early), o.filter(~early)):
        store.upsert(entity_batch(batch), "slv_asset", ["asset_nk"], keep=("first_seen_at",))
    return store.read("slv_asset")


@query(
    "upsert_fact_snapshot",
    """
    SELECT CASE year(o_orderdate) WHEN 1996 THEN NULL WHEN 1997 THEN 'a:b' WHEN 1998 THEN 'a%b' ELSE 'y' || year(o_orderdate) END AS slice,
           o_custkey AS asset_sk, count(*) AS orders_placed,
           CASE WHEN year(o_orderdate) IN (1996, 1997, 1998) THEN 'second' ELSE 'first' END AS loaded_by
    FROM orders GROUP BY ALL
    """,
)
def upsert_fact_snapshot(spark, sf):
    """A second load of some slices replaces those only, among them a null one and names that need escaping."""
    store = TableStore(spark, scratch(spark, "fact"))
    year = F.year("o_orderdate")
    named = e.case((year == 1996, F.lit(None)), (year == 1997, "a:b"), (year == 1998, "a%b"), default=F.concat(F.lit("y"), e.text(year)))
    fact = table(spark, sf, "orders").groupBy(named.alias("slice"), F.col("o_custkey").alias("asset_sk")).agg(row_count("orders_placed"))
    keys = ["slice", "asset_sk"]
    store.upsert_slices(fact.withColumn("loaded_by", F.lit("first")), "fact", keys, "slice")
    again = fact.filter("slice IS NULL OR slice IN ('a:b', 'a%b')")
    store.upsert_slices(again.withColumn("loaded_by", F.lit("second")), "fact", keys, "slice")
    return store.read("fact").select("slice", "asset_sk", "orders_placed", "loaded_by")


@query("json_partition_sink", "SELECT o_orderkey, o_custkey, o_orderpriority, strftime(o_orderdate, '%Y') AS ingest_date FROM orders")
def json_partition_sink(spark, sf):
    root = scratch(spark, "json-sink")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.date_format("o_orderdate", "yyyy").alias("ingest_date"))
    landing_sink.land_json(rows, root, ["ingest_date"])
    schema = schemas.T.StructType([f for f in rows.schema.fields if f.name != "ingest_date"])
    back = landing.with_source_path(landing.read_json(spark, root, schema, multiline=False))
    return back.withColumn("ingest_date", partition_value("ingest_date")).drop("source_path")


@query(
    "checkpoint_skip",
    """
    SELECT CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN 'a:b%c' ELSE o_orderstatus END AS unit, count(*) AS row_count,
           CASE unit WHEN 'O' THEN 'refreshed' WHEN 'P' THEN 'second' ELSE 'first' END AS landed_by
    FROM orders GROUP BY 1
    """,
)
def checkpoint_skip(spark, sf):
    """F, the null unit and one whose name needs escaping land first and are skipped later; O lands first and is refreshed;
    P is new the second time."""
    root = scratch(spark, "checkpoint")
    key = F.col("o_orderkey")
    unit = e.case((key % 5 == 0, F.lit(None)), (key % 5 == 1, "a:b%c"), default=F.col("o_orderstatus"))
    rows = table(spark, sf, "orders").select("o_orderkey", unit.alias("unit"))
    by = lambda name, df: df.withColumn("landed_by", F.lit(name))
    landing_sink.land_missing(by("first", rows.filter("unit IS NULL OR unit <> 'P'")), root, ["unit"])
    landing_sink.land_missing(by("second", rows), root, ["unit"])
    landing_sink.land_missing(by("refreshed", rows.filter("unit = 'O'")), root, ["unit"], force_refresh=True)
    back = spark.read.schema("o_orderkey long, landed_by string, unit string").json(root)
    return back.groupBy("unit", "landed_by").agg(row_count())


@query("preview_show", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def preview_show(spark, sf):
    return table(spark, sf, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey", "o_totalprice")


@query(
    "load_status_summary",
    """
    SELECT status, count(*) AS units, CAST(coalesce(sum(CASE WHEN status = 'done' THEN l_linenumber END), 0) AS BIGINT) AS rows_done
    FROM (SELECT l_linenumber, CASE l_returnflag WHEN 'A' THEN 'done' WHEN 'N' THEN 'skipped' ELSE 'error' END AS status FROM lineitem) GROUP BY 1
    """,
)
def load_status_summary(spark, sf):
    flag = F.col("l_returnflag")
    log = table(spark, sf, "lineitem").select(
        e.case((flag == "A", "done"), (flag == "N", "skipped"), default="error").alias("status"), F.col("l_linenumber").alias("rows")
    )
    return landing_sink.load_summary(log)


# -- feed and stream -----------------------------------------------------------------------------
@query(
    "feed_notices",
    """
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS created, o_orderpriority AS title, o_orderstatus AS status,
           CAST(NULL AS VARCHAR) AS retire_date, CAST(NULL AS BIGINT) AS retire_year
    FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
    QUALIFY row_number() OVER (PARTITION BY o_orderdate, o_orderpriority ORDER BY o_custkey, o_orderkey) = 1
    """,
)
def feed_notices(spark, sf):
    """Tag filter, text filter, normalisation and first-in-feed dedupe together."""
    items = table(spark, sf, "orders").select(
        F.lit("feed").alias("source_path"), F.col("o_custkey").alias("page_no"), F.col("o_orderkey").alias("item_no"),
        F.concat(F.lit(" "), "o_orderpriority").alias("title"), F.lit(None).cast("string").alias("description"),
        F.col("o_orderstatus").alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd'T00:00:00Z'").alias("created"),
        F.when(F.col("o_orderstatus") != "P", F.array(F.lit("Retirements"))).alias("tags"),
    )
    return feed.retirement_notices(items, "urgent|high|medium|not specified")


@query(
    "stream_inventory_load",
    """
    SELECT resource_id, resource_type, location, sku_tier, provisioning_state, subscription_id, CASE WHEN tag_env IS NULL THEN 1 ELSE 2 END AS tags,
           tag_owner AS owner, count(*) OVER (PARTITION BY subscription_id) AS resources_of_account,
           CASE WHEN CAST(substr(resource_id, 2) AS BIGINT) % 3 = 0 THEN 0 ELSE 1 END AS load_batch
    FROM resource
    """,
)
def stream_inventory_load(spark, sf):
    """Snapshots land in two steps and are loaded after each; the second batch comes once more, as after a crash."""
    root = scratch(spark, "stream-inventory")
    store = TableStore(spark, f"{root}/tables")
    rows = landed_resources(spark, sf).withColumn("properties", F.from_json("properties", PROPERTY_STRUCT))
    first = F.substring("id", 2, 20).cast("long") % 3 == 0
    for run_id, part in (("a", rows.filter(first)), ("b", rows.filter(~first))):
        landing_sink.land_json(part.withColumn("run_id", F.lit(run_id)), f"{root}/landing", ["run_id"])
        incremental.stream_inventory(store, f"{root}/landing", f"{root}/log", e.RUN_TS, multiline=False).awaitTermination()
    again = landing.read_snapshots(spark, f"{root}/landing/run_id=b", multiline=False)
    incremental.inventory_batch(store, e.RUN_TS, path=f"{root}/landing")(again, 1)
    flat, raw = store.read("brz_azure_resource_flat"), store.read("brz_azure_resource_raw")
    tags = store.read("brz_inventory_tag_raw").groupBy("resource_id").agg(
        row_count("tags"), F.max(F.when(F.col("tag_key") == "Owner", F.col("tag_value"))).alias("owner")
    )
    accounts = store.read("brz_inventory_cloud_raw").select("subscription_id").distinct()
    counted = raw.select(F.get_json_object("raw_payload", "$.subscription_id").alias("subscription_id")).groupBy("subscription_id")
    counted = counted.agg(row_count("resources_of_account")).join(accounts, "subscription_id")
    return flat.join(tags, "resource_id").join(counted, "subscription_id").select(
        "resource_id", "resource_type", "location", "sku_tier", "provisioning_state", "subscription_id", "tags", "owner", "resources_of_account",
        F.col("load_batch").cast("int").alias("load_batch"),
    )


@query(
    "stream_notice_events",
    """
    SELECT sha256('microsoft|' || notice_id) AS deprecation_sk, title AS notice_title, published_at, retirement_at, status,
           CASE WHEN title LIKE '%AKS%' THEN 'containers' WHEN title LIKE '%Web App%' THEN 'compute' WHEN title LIKE '%Cosmos%' THEN 'data'
                WHEN title LIKE '%Blob%' THEN 'storage' WHEN title LIKE '%Key Vault%' THEN 'security' WHEN title LIKE '%DNS%' THEN 'network'
                ELSE 'platform' END AS technology_family
    FROM notice_base
    """,
)
def stream_notice_events(spark, sf):
    """Notices of three runs, loaded after each by the notice stream: events carry the newest file's status and dates."""
    root = scratch(spark, "stream-notices")
    store = TableStore(spark, f"{root}/tables")
    # Three runs land from these rows, which are grouped once.
    rows = staged(landed(spark, sf).drop("source_path"), "stream-notices-rows")
    for status in ("F", "O", "P"):
        landing_sink.land_json(rows.filter(F.col("status") == status).withColumn("run_id", F.lit(status)), f"{root}/landing", ["run_id"])
        run = incremental.stream_notices(store, f"{root}/landing", f"{root}/log", e.AS_OF, e.RUN_TS, multiline=False)
        run.awaitTermination()
    events = store.read("slv_deprecation_event")
    return events.select(
        "deprecation_sk", "notice_title", e.ts_text("published_at").alias("published_at"), e.ts_text("retirement_at").alias("retirement_at"),
        "status", "technology_family",
    )


@query(
    "stream_incremental_load",
    "SELECT o_custkey AS asset_nk, max(o_orderkey) AS o_orderkey, count(*) > 0 AS seen FROM orders GROUP BY 1",
)
def stream_incremental_load(spark, sf):
    """Files arriving in two steps, loaded by two availableNow runs of one stream."""
    base = scratch(spark, "stream")
    store = TableStore(spark, f"{base}/tables")
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("asset_nk"), "o_orderkey", F.col("o_orderstatus").alias("unit"))

    def newest(batch):
        known = store.read("slv_asset") if store.exists("slv_asset") else batch.sparkSession.createDataFrame([], "asset_nk long, o_orderkey long, seen boolean")
        both = batch.select("asset_nk", "o_orderkey").unionByName(known.select("asset_nk", "o_orderkey"))
        return both.groupBy("asset_nk").agg(F.max("o_orderkey").alias("o_orderkey")).withColumn("seen", F.lit(True))

    schema = schemas.T.StructType([f for f in rows.schema.fields if f.name != "unit"])
    for part in (rows.filter("unit = 'F'"), rows.filter("unit <> 'F'")):
        landing_sink.land_json(part, f"{base}/landing", ["unit"])
        source = incremental.stream_json(spark, f"{base}/landing", schema, multiline=False).drop("source_path")
        run = incremental.upsert_stream(source, store, "slv_asset", ["asset_nk"], f"{base}/log", newest)
        run.awaitTermination()
    return store.read("slv_asset")
