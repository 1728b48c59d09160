"""Upserts, stores, landing and streams in a fresh folder."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from duskline.operators.upsert import merge_rows, one_row_per_key
from duskline.operators import filters
from duskline.plans import feed, quality, runs, silver
from duskline.plans import measures as m
from duskline.session import scratch, staged, working_dir
from duskline.sinks import landing as sink
from duskline.sinks.tables import TableStore, bucket_of
from duskline.sources import landing, reference, schemas
from duskline.streaming.incremental import inventory_batch, stream_inventory, stream_notices


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "tables"))


def test_merge_rows(spark, rows):
    target = spark.createDataFrame([(1, "a", "t1", "old"), (2, "b", "t1", "old")], "k int, v string, first_seen_at string, only_old string")
    source = spark.createDataFrame([(2, None, "t2", "n"), (3, "c", "t2", "n")], "k int, v string, first_seen_at string, only_new string")
    merged = merge_rows(target, source, ["k"], keep=("first_seen_at",))
    assert rows(merged, "k", "v", "first_seen_at", "only_old", "only_new") == [
        (1, "a", "t1", "old", None), (2, None, "t1", "old", "n"), (3, "c", "t2", None, "n"),
    ]
    again = merge_rows(merged, source, ["k"], keep=("first_seen_at",))
    assert rows(again) == rows(merged)


def test_one_row_per_key(spark, rows):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 0), (2, "c", None)], "k int, v string, n int")
    assert rows(one_row_per_key(df, ["k"])) == [(1, "b", 0), (2, "c", None)]
    with pytest.raises(Exception, match="more than one source row"):
        one_row_per_key(df, ["k"], strict=True).collect()
    assert one_row_per_key(df.filter("v <> 'a'"), ["k"], strict=True).count() == 2


def test_store_versions(spark, store, rows):
    assert not store.exists("t") and store.missing(["t"]) == ["t"]
    store.append(spark.sql("SELECT 1 AS a"), "t")
    store.append(spark.sql("SELECT 2 AS a, 'x' AS b"), "t")
    assert rows(store.read("t", evolving=True)) == [(1, None), (2, "x")]
    store.overwrite(store.read("t", evolving=True).filter("a = 2"), "t")
    assert rows(store.read("t")) == [(2, "x")]
    # A version without its marker is the rest of a failed write.
    spark.sql("SELECT 9 AS a").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{store.root}/t/v=000009")
    assert rows(store.read("t")) == [(2, "x")]
    counts = {r["table_name"]: r["row_count"] for r in store.row_counts(["t", "none"]).collect()}
    assert counts == {"t": 1, "none": -1}
    with pytest.raises(LookupError):
        store.read("none")
    with pytest.raises(quality.EmptySource):
        quality.require_tables(store, ["t", "none"])


def test_upsert_slices_leaves_history_alone(spark, store, rows, tmp_path):
    day = lambda d, k, v: spark.createDataFrame([(d, x, v) for x in k], "date_sk int, k string, v string")
    store.upsert_slices(day(20260101, "ab", "1"), "f", ["date_sk", "k"], "date_sk")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "tables" / "f").rglob("date_sk=20260101/*.parquet")}
    store.upsert_slices(day(20260102, "a", "2"), "f", ["date_sk", "k"], "date_sk")
    store.upsert_slices(day(20260102, "ac", "3"), "f", ["date_sk", "k"], "date_sk")
    named = day(20260103, "ab", "4")
    store.upsert_slices(named, "f", ["date_sk", "k"], "date_sk", unique=True)
    store.upsert_slices(named.filter("k = 'a'").withColumn("v", F.lit("5")), "f", ["date_sk", "k"], "date_sk", unique=True)
    assert rows(store.read("f").filter("date_sk = 20260103"), "k", "v") == [("a", "5"), ("b", "4")]
    assert before and before == {p: p.stat().st_mtime_ns for p in (tmp_path / "tables" / "f").rglob("date_sk=20260101/*.parquet")}
    assert rows(store.read("f").filter("date_sk < 20260103"), "date_sk", "k", "v") == [
        (20260101, "a", "1"), (20260101, "b", "1"), (20260102, "a", "3"), (20260102, "c", "3"),
    ]


def test_empty_fact_can_be_filled(spark, store):
    name = "fact_deprecation_impact"
    store.overwrite(reference.empty_impacts(spark), name, partition_by=["date_sk"])
    assert store.exists(name) and store.read(name).count() == 0
    row = spark.sql("SELECT 20260101 AS date_sk, 'a' AS asset_sk, 'n' AS deprecation_sk, 't' AS technology_sk")
    full = reference.empty_impacts(spark).unionByName(row, allowMissingColumns=True)
    store.upsert_slices(full, name, ["date_sk", "asset_sk", "deprecation_sk", "technology_sk"], "date_sk")
    assert store.read(name).count() == 1


def write(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content if isinstance(content, str) else json.dumps(content), encoding="utf-8")


def test_snapshot_arrays(spark, tmp_path, rows):
    one = {"id": "/r/1", "name": "a", "type": "T/x", "subscription_id": "s", "sku": {"name": "n"}, "tags": {"Env": "p"},
           "properties": {"creationDate": "1", "creationdate": "2", "n": {"Deep": True}}}
    write(tmp_path / "ingest_date=2026-01-01" / "run_id=1" / "resources.json", [one, {"id": "/r/2", "properties": None}])
    write(tmp_path / "ingest_date=2026-01-02" / "run_id=2" / "resources.json", [])
    df = landing.read_snapshots(spark, str(tmp_path))
    assert df.count() == 2
    got = df.filter("id = '/r/1'").select(
        F.get_json_object("properties", "$.creationdate"), F.get_json_object("properties", "$.n.Deep"), "sku.name", "source_path"
    ).first()
    assert tuple(got)[:3] == ("2", "true", "n") and got["source_path"].endswith("run_id=1/resources.json")
    assert landing.read_recommendations(spark, str(tmp_path / "ingest_date=2026-01-02")).columns == schemas.RECOMMENDATION.names
    run = landing.read_run(spark, str(tmp_path), schemas.RESOURCE, multiline=True, ingest_date="2026-01-01", run_id="1")
    assert run.count() == 2


def test_every_landed_page_counts(spark, tmp_path, rows):
    item = lambda t: {"title": t, "tags": ["Retirements"]}
    write(tmp_path / "ok" / "page-0.json", '{"value": [{"title": "a\u0001b"}, {"title": "c"}]}')
    write(tmp_path / "ok" / "page-1.json", {"value": [item("d")]})
    write(tmp_path / "ok" / "page-2.json", {"value": []})
    write(tmp_path / "ok" / "page-3.json", {"value": [item("late")]})
    pages = landing.read_feed_pages(spark, str(tmp_path / "ok"), schemas.FEED_ITEM)
    number = F.regexp_extract("source_path", r"page-(\d+)", 1)
    assert rows(landing.explode_pages(pages, number), "page_no", "item_no", "title") == [
        (0, 0, "a\u0001b"), (0, 1, "c"), (1, 0, "d"), (3, 0, "late")
    ]
    # Without page numbers the items stay, placed by file.
    assert rows(landing.explode_pages(pages), "page_no", "title") == rows(
        landing.explode_pages(pages).withColumn("page_no", F.lit(None).cast("long")), "page_no", "title"
    )
    assert landing.explode_pages(pages).count() == 4
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "page-0.json").write_bytes(b'{"value": [{"title": "x\xff\xc3y"}]}')
    bad = landing.read_feed_pages(spark, str(tmp_path / "bad"), schemas.FEED_ITEM)
    assert landing.explode_pages(bad, number).first()["title"].startswith("x\ufffd")


def test_land_missing(spark, tmp_path, rows):
    root = str(tmp_path / "landed")
    df = spark.createDataFrame([("2026-01-01", 1), ("a b/c", 2)], "day string, n int")
    sink.land_missing(df, root, ["day"])
    sink.land_missing(df.withColumn("n", F.col("n") + 10), root, ["day"])
    read = lambda: rows(landing.read_json(spark, root, "n int", multiline=False))
    assert read() == [(1,), (2,)]
    sink.land_missing(df.filter("n = 2").withColumn("n", F.lit(12)), root, ["day"], force_refresh=True)
    assert read() == [(1,), (12,)]
    log = spark.createDataFrame([("done", 5), ("done", 7), ("error", None), ("skipped", 0)], "status string, rows int")
    assert rows(sink.load_summary(log)) == [("done", 2, 12), ("error", 1, 0), ("skipped", 1, 0)]


def test_stream_equals_batch(spark, tmp_path, store, rows):
    notice = lambda t, d: {"created": "2026-01-01", "title": t, "status": "Retired", "retire_date": d, "retire_year": 2026}
    land, log, day = tmp_path / "landing", str(tmp_path / "log"), dt.date(2026, 1, 1)
    write(land / "ingest_date=2026-01-01" / "retirements.json", [notice("SQL old", "2026-02-01"), notice("AKS old", None)])
    stream_notices(store, str(land), log, day, "2026-01-01 00:00:00").awaitTermination()
    write(land / "ingest_date=2026-01-02" / "retirements.json", [notice("SQL old", "2026-02-01"), notice("DNS old", "2026-05-05")])
    write(land / "ingest_date=2026-01-03" / "retirements.json", [])
    for _ in range(2):
        stream_notices(store, str(land), log, day, "2026-01-02 00:00:00").awaitTermination()
    got = rows(store.read("slv_deprecation_event"), "notice_title", "technology_family", "severity", F.col("first_seen_at").cast("string"))
    assert got == [
        ("AKS old", "containers", "critical", "2026-01-01 00:00:00"),
        ("DNS old", "network", "critical", "2026-01-02 00:00:00"),
        ("SQL old", "data", "critical", "2026-01-01 00:00:00"),
    ]


def test_calendar_and_seeds(spark):
    cal = reference.dim_date(spark, dt.date(2026, 6, 1))
    assert cal.count() == sum(366 if y in (2024, 2028) else 365 for y in range(2023, 2029))
    row = cal.filter("date_sk = 20270101").first()
    assert tuple(row) == (20270101, "2027-01-01", 2027, 1, 1, 53, 1, 4, "Friday", "January", False)
    assert reference.dim_environment(spark).count() == 5
    assert reference.dim_cloud_provider(spark).filter("url IS NULL").first()["provider_name"] == "onprem"
    assert [r["risk_order"] for r in reference.dim_risk_band(spark).orderBy("risk_band_sk").collect()] == [4, 3, 2, 1, 0]


def test_working_folder(spark):
    base = working_dir(spark)
    assert base == working_dir(spark)
    first, second = scratch(spark, "x"), scratch(spark, "x")
    assert first != second and first.startswith(base + "/duskline/x-")
    frame = staged(spark.sql("SELECT 1 AS a, map('k', 'v') AS m"), "x")
    assert frame.first()["m"] == {"k": "v"}


def test_scope_and_windows(spark, rows):
    units = spark.createDataFrame([("a", "Enabled"), ("b", "DISABLED"), ("c", None)], "subscription_id string, state string")
    ids = lambda df: [r[0] for r in rows(df, "subscription_id")]
    assert ids(filters.in_scope(units)) == ["a"]
    assert ids(filters.in_scope(units, include_disabled=True)) == ["a", "b", "c"]
    assert ids(filters.in_scope(units, ids=["c", "x"])) == ["c"]
    dated = spark.createDataFrame([(None, None), ("2026-01-01", 2026), ("2025-12-31", 2025), ("2027-01-01", 2027)], "retire_date string, retire_year long")
    pick = lambda **k: [r[0] for r in rows(filters.retirement_window(dated, "2026-01-01", **k), "retire_date")]
    assert pick(upcoming_only=True) == [None, "2026-01-01", "2027-01-01"]
    assert pick(year=2026) == ["2026-01-01"] and pick(since=2026) == ["2026-01-01", "2027-01-01"] and len(pick()) == 4


def test_feed_to_landed_notices(spark, rows):
    items = spark.createDataFrame(
        [(0, 0, " A retires 1 May 2026 ", None, "s1", "2026-01-01T10:00Z", ["Retirements"]),
         (0, 1, "A retires 1 May 2026", "again", "s2", "2026-01-01T11:00Z", ["Retirements", "x"]),
         (1, 0, "B", "on March 3rd, 2025", None, "", ["Retirements"]),
         (1, 1, "C", None, None, None, ["retirements"]), (1, 2, "D", None, None, None, None)],
        "page_no long, item_no int, title string, description string, status string, created string, tags array<string>",
    ).withColumn("source_path", F.lit("p"))
    got = feed.by_retirement(feed.retirement_notices(items)).collect()
    assert [tuple(r) for r in got] == [("", "B", None, "2025-03-03", 2025), ("2026-01-01", "A retires 1 May 2026", "s1", "2026-05-01", 2026)]
    assert feed.retirement_notices(items, "MARCH").count() == 1


def test_affected_share_blank_rules(spark, rows):
    inventory = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", None)], "asset_sk string, region string")
    hit = spark.createDataFrame([("a", "x", True), ("z", "y", True)], "asset_sk string, region string, is_affected boolean")
    got = rows(m.affected_share(inventory, hit, ["region"]), "region", "assets", "affected_assets", "affected_share")
    assert got == [(None, 1, 0, 0.0), ("x", 2, 1, 0.5), ("y", 0, 1, None)]
    none = m.affected_share(inventory.filter("false"), hit).first()
    assert (none["assets"], none["affected_assets"], none["affected_share"]) == (0, 2, None)
    blank = spark.createDataFrame([("a",), (None,)], "asset_sk string").agg(m.assets()).first()[0]
    assert blank == 2


def test_new_files_are_a_frame(spark, tmp_path):
    root = tmp_path / "a landing" / "ingest_date=2026-01-01"
    write(root / "one.json", [{"title": "a", "created": "2026-01-01"}])
    first = landing.new_files(spark, str(tmp_path / "a landing"), None)
    known = landing.read_notices(spark, str(tmp_path / "a landing"))
    assert first.count() == known.count() == 1
    known = staged(known, "known")
    write(root / "two.json", [{"title": "b", "created": "2026-01-02"}])
    fresh = landing.new_files(spark, str(tmp_path / "a landing"), known)
    assert [r["path"].rsplit("/", 1)[1] for r in fresh.collect()] == ["two.json"]


RESOURCE = {"id": "/r/1", "name": "a", "type": "T/x", "subscription_id": "s", "sku": {"name": "n"}, "tags": {"Env": "p", "Owner": "o"}, "properties": {}}
RAW = ("brz_inventory_cloud_raw", "brz_azure_resource_flat", "brz_inventory_tag_raw", "brz_azure_resource_raw")


def raw_rows(store, rows):
    return {n: rows(store.read(n)) for n in RAW}


def test_a_repeated_batch_changes_no_row(spark, tmp_path, store, rows, monkeypatch):
    """The load dies between two of its four tables; its batch comes again under the same number."""
    land, log = tmp_path / "landing", str(tmp_path / "log")
    load = lambda: stream_inventory(store, str(land), log, "2026-01-01 00:00:00").awaitTermination()
    write(land / "run_id=1" / "resources.json", [RESOURCE])
    load()
    write(land / "run_id=2" / "resources.json", [{**RESOURCE, "id": "/r/2"}, {**RESOURCE, "id": "/r/3", "tags": None}])
    put, written = TableStore.put_batch, []

    def dying(self, df, name, batch):
        if len(written) == 2:
            raise RuntimeError("lost")
        written.append(name)
        put(self, df, name, batch)

    monkeypatch.setattr(TableStore, "put_batch", dying)
    with pytest.raises(Exception, match="lost"):
        load()
    assert [store.read(n).count() for n in RAW] == [2, 3, 2, 1]
    monkeypatch.setattr(TableStore, "put_batch", put)
    load()
    assert [store.read(n).count() for n in RAW] == [2, 3, 4, 3]
    before = raw_rows(store, rows)
    batch = landing.read_snapshots(spark, str(land / "run_id=2"))
    inventory_batch(store, "2026-01-01 00:00:00", path=str(land))(batch, 1)  # once more, by hand
    load()
    assert raw_rows(store, rows) == before


def test_a_load_without_tags_keeps_the_columns(spark, tmp_path, store):
    write(tmp_path / "landing" / "resources.json", [{**RESOURCE, "tags": None}])
    stream_inventory(store, str(tmp_path / "landing"), str(tmp_path / "log"), "2026-01-01 00:00:00").awaitTermination()
    tags = store.read("brz_inventory_tag_raw")
    assert tags.count() == 0 and {"resource_id", "load_batch"} <= set(tags.columns)


def test_old_files_are_new_too(spark, tmp_path, store):
    """A file that arrives late with an old date is loaded like any other."""
    land, log = tmp_path / "landing", str(tmp_path / "log")
    write(land / "a.json", [RESOURCE])
    stream_inventory(store, str(land), log, "2026-01-01 00:00:00").awaitTermination()
    write(land / "b.json", [{**RESOURCE, "id": "/r/2"}])
    os.utime(land / "b.json", (1_000_000, 1_000_000))
    stream_inventory(store, str(land), log, "2026-01-01 00:00:00").awaitTermination()
    assert store.read("brz_azure_resource_raw").count() == 2


def test_upsert_touches_only_buckets_with_a_key(spark, store, rows, tmp_path):
    batch = lambda ids, v: spark.createDataFrame([(i, v, v) for i in ids], "k int, v string, first string")
    store.upsert(batch(range(200), "1"), "t", ["k"], keep=("first",), unique=True)
    folders = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "tables" / "t").rglob("*.parquet")}
    before = folders()
    # Bucket -1 is the file that keeps the columns.
    assert {p.parent.name for p in before} == {f"bucket_of_16={n}" for n in range(-1, 16)} and store.read("t").columns == ["k", "v", "first"]
    source = batch([7, 1000], "2")
    touched = {r[0] for r in source.select(bucket_of(["k"], 16)).collect()}
    plan = store.touched_rows("t", source, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket_of_16" in plan
    assert store.touched_rows("t", source, ["k"]).count() < 200
    store.upsert(source, "t", ["k"], keep=("first",))
    after = folders()
    same = {p for p in before if p in after and before[p] == after[p]}
    assert same and {int(p.parent.name.split("=")[1]) for p in before if p not in same} == touched & {int(p.parent.name.split("=")[1]) for p in before}
    got = {r[0]: tuple(r)[1:] for r in store.read("t").collect()}
    assert len(got) == 201 and got[7] == ("2", "1") and got[1000] == ("2", "2") and got[8] == ("1", "1")
    store.upsert(source, "t", ["k"], keep=("first",))
    assert {r[0]: tuple(r)[1:] for r in store.read("t").collect()} == got


def test_upsert_takes_new_columns_null_keys_and_tables_without_buckets(spark, store, rows):
    store.overwrite(spark.sql("SELECT 1 AS k, 'a' AS v UNION ALL SELECT NULL, 'n'"), "t")
    store.upsert(spark.sql("SELECT CAST(NULL AS INT) AS k, 'm' AS v"), "t", ["k"])
    assert rows(store.read("t")) == [(None, "m"), (1, "a")]
    store.upsert(spark.sql("SELECT 2 AS k, 'b' AS v, 'x' AS more"), "t", ["k"])
    assert rows(store.read("t")) == [(None, "m", None), (1, "a", None), (2, "b", "x")]
    store.upsert(spark.sql("SELECT 1 AS k, 'c' AS v"), "t", ["k"])
    assert rows(store.read("t")) == [(None, "m", None), (1, "c", None), (2, "b", "x")]
    store.upsert(spark.sql("SELECT 1 AS k, 'c' AS v WHERE false"), "t", ["k"])
    assert store.read("t").count() == 3


def test_newest_rows_are_kept_from_run_to_run(spark, tmp_path, store, rows):
    """The kept rows equal those of the whole history, late and repeated snapshots included; old batches are not read."""
    land, log = tmp_path / "landing", str(tmp_path / "log")
    days = [
        ("2026-01-01", [{**RESOURCE, "name": "one"}, {**RESOURCE, "id": "/r/2"}, {**RESOURCE, "id": "/r/2"}]),
        ("2026-01-03", [{**RESOURCE, "name": "three"}, {**RESOURCE, "id": None}]),
        ("2026-01-02", [{**RESOURCE, "name": "late"}, {**RESOURCE, "id": "/r/3"}]),
    ]
    for n, (day, content) in enumerate(days):
        write(land / f"run_id={n}" / "resources.json", content)
        stream_inventory(store, str(land), log, f"{day} 00:00:00").awaitTermination()
        if n == 2:  # what has been folded in is not needed again
            for old in (tmp_path / "tables" / "brz_azure_resource_flat").rglob("load_batch=0/*.parquet"):
                old.write_bytes(b"")
        kept = runs.refresh_newest(store)
    got = {r["resource_id"]: (r["resource_name"], str(r["first_seen_at"])[:10], str(r["last_seen_at"])[:10], r["seen_batch"]) for r in kept.collect()}
    assert got == {
        "/r/1": ("three", "2026-01-01", "2026-01-03", 2), "/r/2": ("a", "2026-01-01", "2026-01-01", 0),
        None: ("a", "2026-01-03", "2026-01-03", 1), "/r/3": ("a", "2026-01-02", "2026-01-02", 2),
    }
    before = rows(kept)
    assert rows(runs.refresh_newest(store)) == before


def test_newest_resource_aggregates_no_wide_column(spark):
    flat = spark.sql("SELECT 'r' AS resource_id, 'big' AS properties_json, 'f' AS source_path, timestamp'2026-01-01' AS collected_at")
    plan = silver.newest_resource(flat.unionByName(flat).repartition(2))._jdf.queryExecution().optimizedPlan().toString()
    assert all("properties_json" not in line for line in plan.splitlines() if "Aggregate [" in line)


def test_upsert_of_every_bucket_is_a_new_version(spark, store, rows):
    """Nothing is staged for it; an upsert of some buckets stays within the version."""
    made = lambda: [f for f in os.listdir(f"{working_dir(spark)}/duskline") if f.startswith("buckets-whole-")]
    staged(spark.range(1), "any")
    store.upsert(spark.range(200).select("id", F.lit("a").alias("v"), F.lit(1).alias("first")), "whole", ["id"], ("first",))
    store.upsert(spark.range(100, 400).select("id", F.lit("b").alias("v"), F.lit(2).alias("first")), "whole", ["id"], ("first",))
    assert store._versions("whole") == [1, 2] and not made()
    want = [(i, "a" if i < 100 else "b", 1 if i < 200 else 2) for i in range(400)]
    assert sorted(tuple(r) for r in store.read("whole").collect()) == want
    store.upsert(spark.range(1).select("id", F.lit("c").alias("v"), F.lit(3).alias("first")), "whole", ["id"], ("first",))
    assert store._versions("whole") == [1, 2] and len(made()) == 1
    assert sorted(tuple(r) for r in store.read("whole").collect()) == [(0, "c", 1), *want[1:]]


def test_notice_batches_are_unique_already(spark, tmp_path, store, monkeypatch):
    """The newest row of each notice is found once; the upsert does not look for it again."""

    def again(*_, **__):
        raise AssertionError("made unique twice")

    monkeypatch.setattr("duskline.sinks.tables.one_row_per_key", again)
    days = spark.createDataFrame([("2024-01-01", "t", "Open", "2026-01-01", 2026), ("2024-01-01", "t", "Retired", "2026-01-01", 2026)], "created string, title string, status string, retire_date string, retire_year long")
    sink.land_json(days.withColumn("run_id", F.lit("a")), str(tmp_path / "in"), ["run_id"])
    stream_notices(store, str(tmp_path / "in"), str(tmp_path / "log"), dt.date(2025, 1, 1), "2025-01-01 00:00:00", multiline=False).awaitTermination()
    assert store.read("slv_deprecation_event").count() == 1
