"""Landed files to the star, twice: same keys, nothing doubled."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from duskline.operators.technology import detect_technology
from duskline.plans import bronze, quality, runs, silver
from duskline.sinks.tables import TableStore
from duskline.sources import schemas

DAY = dt.date(2026, 1, 1)


def resource(n, kind, name, properties, tags=None, group="g1", location="eastus"):
    return {"id": f"/r/{n}", "name": name, "type": kind, "subscription_id": "sub-prod", "resource_group": group, "location": location,
            "kind": None, "sku": {"name": "S1", "tier": "std"}, "tags": tags, "properties": properties}


RESOURCES = [
    resource(1, "Microsoft.Web/sites", "Func", {"siteConfig": {"linuxFxVersion": "PYTHON|3.9"}, "provisioningState": "Succeeded"},
             {"Env": "prod", "owner": " Team-A "}),
    resource(2, "Microsoft.Web/sites", "core", {"siteConfig": {"linuxFxVersion": "DOTNETCORE"}}),
    resource(3, "Microsoft.Web/sites", "blank", {"siteConfig": {"linuxFxVersion": ""}}, {}),
    resource(4, "Microsoft.ContainerService/managedClusters", "aks", {"kubernetesVersion": "1.27", "currentKubernetesVersion": "1.28"}),
    resource(5, "Microsoft.KeyVault/vaults", "kv", {"enableRbacAuthorization": False, "enableSoftDelete": True}),
    resource(6, "Microsoft.Compute/virtualMachines", "vm",
             {"storageProfile": {"osDisk": {"osType": "Linux"}, "imageReference": {"offer": "ubuntu", "sku": "22_04"}}}),
    resource(7, "Microsoft.Sql/servers", "db", {"version": "12.0", "currentServiceObjectiveName": "S0"}),
    resource(8, "Microsoft.Storage/storageAccounts", "st", {"minimumTlsVersion": "TLS1_2", "creationDate": "1", "creationdate": "2"}),
    resource(9, "Microsoft.Storage/storageAccounts", "ST ", {"minimumTlsVersion": "TLS1_0"}, group="g2", location="marsnorth"),
    resource(10, "Microsoft.X/y", None, None),
]
NOTICES = [
    {"created": "2025-12-01", "title": "AKS 1.28 retires", "status": "Retirement planned", "retire_date": "2026-02-01", "retire_year": 2026},
    {"created": "2025-12-02", "title": "SQL tier going away", "status": "Launched", "retire_date": None, "retire_year": None},
    {"created": "", "title": "Blob thing", "status": None, "retire_date": "2027-01-01", "retire_year": 2027},
]


def write(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(content), encoding="utf-8")


def run_all(store, root, run_ts, crosswalk=True):
    runs.load_inventory(store, f"{root}/inventory", run_ts)
    runs.load_notices(store, f"{root}/notices", run_ts)
    runs.conform_inventory(store, run_ts)
    runs.conform_notices(store, DAY, run_ts)
    runs.publish_inventory(store, DAY, run_ts)
    runs.publish_impact(store, DAY, run_ts, use_crosswalk=crosswalk)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("e2e")
    write(root / "inventory" / "ingest_date=2026-01-01" / "run_id=a" / "resources.json", RESOURCES)
    write(root / "notices" / "ingest_date=2026-01-01" / "retirements.json", NOTICES)
    store = TableStore(spark, str(root / "tables"))
    run_all(store, root, "2026-01-01 06:00:00")
    return root, store


def picked(df, *columns):
    return {r[0]: tuple(r)[1:] for r in df.select(*columns).collect()}


def test_entities(loaded):
    _, store = loaded
    assets = store.read("slv_asset")
    # Two storage accounts share type and folded name, so they share the natural key.
    assert assets.count() == 9
    by_id = picked(assets, "native_resource_id", "environment", "owner_team", "region", "provisioning_state", "asset_name")
    assert by_id["/r/1"] == ("prod", "team-a", "East US", "Succeeded", "Func")
    assert by_id["/r/10"] == ("unknown", "unknown", "East US", None, None)
    accounts = store.read("slv_cloud_account").first()
    assert (accounts["account_nk"], accounts["environment"]) == ("sub-prod", "production")


def test_technologies(loaded):
    _, store = loaded
    tech = store.read("slv_asset_technology")
    got = sorted(tuple(str(v) for v in r) for r in tech.select("resource_id", "technology_family", "runtime_name", "runtime_version", "feature_flag").collect())
    assert got == sorted([
        ("/r/1", "app_runtime", "python", "3.9", "None"), ("/r/2", "app_runtime", "dotnetcore", "None", "None"),
        ("/r/4", "container_orchestration", "kubernetes", "1.28", "None"),
        ("/r/5", "key_vault_config", "rbac_authorization", "None", "false"), ("/r/5", "key_vault_config", "soft_delete", "None", "true"),
        ("/r/6", "virtual_machine", "linux", "22_04", "ubuntu"), ("/r/7", "database", "sql", "12.0", "S0"),
        ("/r/8", "storage_config", "tls", "TLS1_2", "None"), ("/r/9", "storage_config", "tls", "TLS1_0", "None"),
    ])


def test_impact_with_and_without_crosswalk(spark, loaded):
    root, store = loaded
    impact = store.read("fact_deprecation_impact")
    events = store.read("slv_deprecation_event").select("deprecation_sk", "notice_title")
    got = sorted(tuple(r) for r in impact.join(events, "deprecation_sk").select("notice_title", "risk_band_sk", "days_to_retirement").collect())
    # Only one of the two storage accounts is the asset of their shared key.
    assert got == [("AKS 1.28 retires", "2", 31), ("Blob thing", "4", 365), ("SQL tier going away", "3", None)]
    plain = TableStore(spark, str(root / "plain"))
    run_all(plain, root, "2026-01-01 06:00:00", crosswalk=False)
    assert plain.read("fact_inventory_snapshot").count() == 9
    assert plain.read("fact_deprecation_impact").count() == 0


def test_second_run_changes_nothing_but_what_is_new(spark, loaded):
    root, store = loaded
    raw = store.read("brz_azure_resource_raw").count()
    keys = {n: picked(store.read(n), k, s) for n, k, s in (("slv_asset", "asset_nk", "asset_sk"), ("slv_cloud_account", "account_nk", "account_sk"))}
    facts = {n: store.read(n).count() for n in ("fact_inventory_snapshot", "fact_deprecation_impact")}
    run_all(store, root, "2026-01-01 09:00:00")
    assert store.read("brz_azure_resource_raw").count() == raw
    assert {n: picked(store.read(n), k, s) for n, k, s in (("slv_asset", "asset_nk", "asset_sk"), ("slv_cloud_account", "account_nk", "account_sk"))} == keys
    assert {n: store.read(n).count() for n in facts} == facts
    # A later snapshot moves one resource and no longer has the others.
    write(root / "inventory" / "ingest_date=2026-01-02" / "run_id=b" / "resources.json", [{**RESOURCES[0], "location": "ukwest"}])
    write(root / "notices" / "ingest_date=2026-01-02" / "retirements.json", NOTICES[:1])
    run_all(store, root, "2026-01-02 06:00:00")
    seen = picked(store.read("slv_asset").select("native_resource_id", "region", F.col("first_seen_at").cast("string").alias("f"), F.col("last_seen_at").cast("string").alias("l")), "native_resource_id", "region", "f", "l")
    assert seen["/r/1"] == ("UK West", "2026-01-01 06:00:00", "2026-01-02 06:00:00")
    assert seen["/r/2"] == ("East US", "2026-01-01 06:00:00", "2026-01-01 06:00:00")
    assert store.read("slv_deprecation_event").count() == 3
    assert store.read("slv_asset").count() == 9
    quality_rows = quality.duplicate_assets(store.read("slv_asset")).count()
    assert quality_rows == 0
    orphans = quality.orphan_keys(store.read("fact_deprecation_impact"), "asset_sk", store.read("dim_asset"), "asset_sk")
    assert orphans.count() == 0


def test_per_file_notice_ids(spark):
    df = spark.createDataFrame([("2026-01-01", "t", "s", None, None, p) for p in ("f1", "f2")],
                               "created string, title string, status string, retire_date string, retire_year long, source_path string")
    assert bronze.notice_bronze(df, "2026-01-01 00:00:00").select("notice_id").distinct().count() == 1
    assert bronze.notice_bronze(df, "2026-01-01 00:00:00", per_file=True).select("notice_id").distinct().count() == 2
    base = silver.notice_base(bronze.notice_bronze(df, "2026-01-01 00:00:00"), DAY)
    assert base.count() == 1


def test_group_in_key_keeps_same_names_apart(spark):
    df = spark.createDataFrame([tuple(json.dumps(r[c]) if c == "properties" else r[c] for c in schemas.RESOURCE.names) for r in RESOURCES], schemas.RESOURCE)
    loaded_rows = bronze.bronze_metadata(df, "2026-01-01 00:00:00", source_path="x")
    flat, tags = bronze.flatten_resource(loaded_rows), bronze.resource_tags(loaded_rows)
    assert len(flat.columns) == 41
    newest = silver.newest_resource(flat)
    assert silver.asset(newest, tags, "2026-01-01 00:00:00").count() == 9
    assert silver.asset(newest, tags, "2026-01-01 00:00:00", include_group=True).count() == 10


def test_detection_needs_a_known_column(spark):
    with pytest.raises(ValueError):
        detect_technology(spark.sql("SELECT 'r' AS resource_id, 't' AS resource_type, 's' AS subscription_id, 'n' AS resource_name"))
    with pytest.raises(quality.EmptySource):
        quality.require_rows(spark.range(0), "nothing")
