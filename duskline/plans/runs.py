"""The whole load, step by step: landed files to silver entities to the star."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from duskline.operators.matching import crosswalk_family
from duskline.plans import bronze, gold, quality, silver
from duskline.plans.bronze import Origin
from duskline.session import staged
from duskline.sinks.tables import BATCH, TableStore
from duskline.sources import reference
from duskline.streaming import incremental

KEEP = ("first_seen_at",)


def _load(store: TableStore, run: StreamingQuery, path: str, name: str) -> None:
    """Wait for a stream that fills table ``name``. A landing zone without rows raises at the first load."""
    run.awaitTermination()
    quality.require_rows(store.read(name) if store.exists(name) else store.spark.range(0), path)


def load_inventory(store: TableStore, path: str, run_ts, origin: Origin = Origin(), multiline: bool = True) -> None:
    """Load the snapshots that have not been loaded yet into the four raw tables.

    The stream's log, below the store, knows the loaded files; new ones come in numbered
    batches. A load that dies is run again: its batches replace what they had written.
    """
    run = incremental.stream_inventory(store, path, f"{store.root}/_streams/inventory", run_ts, origin, multiline)
    _load(store, run, path, "brz_azure_resource_raw")


def load_notices(store: TableStore, path: str, run_ts, origin: Origin = Origin(), multiline: bool = True) -> None:
    """Load notices from files that have not been loaded yet, as :func:`load_inventory`."""
    run = incremental.stream_raw_notices(store, path, f"{store.root}/_streams/notices", run_ts, origin, multiline)
    _load(store, run, path, "brz_deprecation_raw")


NEWEST = "slv_resource_newest"


def refresh_newest(store: TableStore):
    """The newest row of each resource, kept from run to run: only batches loaded since the last run are read.

    A batch that a died run had folded in is folded in again, which changes nothing.
    """
    done = store.read(NEWEST).agg(F.max("seen_batch")).first()[0] if store.exists(NEWEST) else None
    flat = store.read_batches("brz_azure_resource_flat", -2 if done is None else done)
    if flat is not None:
        store.fold(flat.withColumn("seen_batch", F.col(BATCH)), NEWEST, ["resource_id"], silver.newest_resource)
    return store.read(NEWEST)


def conform_inventory(store: TableStore, run_ts, origin: Origin = Origin()) -> None:
    """Upsert accounts, assets and technologies."""
    newest = refresh_newest(store).drop("seen_batch", BATCH)
    tags = store.read("brz_inventory_tag_raw", evolving=True)
    accounts = store.read("brz_inventory_cloud_raw", evolving=True)
    store.upsert(silver.cloud_account(accounts, run_ts, origin), "slv_cloud_account", ["account_nk"], KEEP)
    store.upsert(silver.asset(newest, tags, run_ts, origin), "slv_asset", ["asset_nk"], KEEP)
    store.upsert(
        silver.technology(newest, run_ts, origin),
        "slv_asset_technology",
        ["resource_id", "technology_family", "technology_source"],
    )


def conform_notices(store: TableStore, as_of: dt.date, run_ts, origin: Origin = Origin()) -> None:
    """Upsert events, notices and the technologies they name."""
    raw = quality.require_rows(store.read("brz_deprecation_raw", evolving=True), "brz_deprecation_raw")
    # Three tables start from it.
    base = staged(silver.notice_base(raw, as_of), "notice-base")
    events = silver.deprecation_event(base, run_ts, origin)
    store.upsert(events, "slv_deprecation_event", ["deprecation_sk"], KEEP)
    store.upsert(silver.source_notice(base, run_ts), "slv_source_notice", ["vendor", "notice_id"], KEEP)
    store.upsert(
        silver.impacted_technology(events, run_ts), "slv_impacted_technology", ["deprecation_sk", "technology_nk"], KEEP
    )


def _publish_day(store: TableStore, facts, name: str, keys: list[str], as_of: dt.date) -> None:
    """Upsert the slice of one day. The fact builders give one row per key."""
    store.upsert_slices(facts, name, keys, "date_sk", unique=True)


def publish_inventory(store: TableStore, as_of: dt.date, run_ts) -> None:
    """Dimensions and the inventory fact of the day."""
    spark = store.spark
    quality.require_tables(store, ["slv_cloud_account", "slv_asset", "slv_asset_technology"])
    assets, technology = store.read("slv_asset"), store.read("slv_asset_technology")
    store.overwrite(reference.dim_date(spark, as_of), "dim_date")
    store.overwrite(reference.dim_environment(spark), "dim_environment")
    store.overwrite(reference.dim_cloud_provider(spark), "dim_cloud_provider")
    store.overwrite(reference.dim_risk_band(spark), "dim_risk_band")
    store.overwrite(gold.dim_account(store.read("slv_cloud_account"), run_ts), "dim_account")
    store.overwrite(gold.dim_asset(assets, run_ts), "dim_asset")
    store.overwrite(gold.dim_technology(technology, run_ts), "dim_technology")
    facts = gold.fact_inventory(assets, technology, as_of, run_ts)
    _publish_day(store, facts, "fact_inventory_snapshot", ["date_sk", "asset_sk"], as_of)
    if not store.exists("fact_deprecation_impact"):
        store.overwrite(reference.empty_impacts(spark), "fact_deprecation_impact", partition_by=["date_sk"])


def publish_impact(store: TableStore, as_of: dt.date, run_ts, use_crosswalk: bool = False) -> None:
    """The impact fact of the day.

    ``use_crosswalk`` maps detected families to notice families first; off, the
    two vocabularies share no family and nothing matches.
    """
    needed = ["slv_deprecation_event", "slv_impacted_technology", "slv_asset", "slv_asset_technology", "dim_technology"]
    quality.require_tables(store, needed)
    events, impacted, assets, technology, dim = [store.read(n) for n in needed]
    quality.require_rows(events, "slv_deprecation_event")
    if use_crosswalk:
        technology, dim = crosswalk_family(technology), crosswalk_family(dim)
    facts = gold.fact_impact(impacted, technology, assets, events, dim, as_of, run_ts)
    _publish_day(store, facts, "fact_deprecation_impact", gold.IMPACT_KEYS, as_of)
