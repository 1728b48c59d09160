"""Dimensions, the inventory snapshot fact and the impact fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskline.functions.keys import hash_key
from duskline.functions.risk import with_risk
from duskline.operators.dedupe import first_per_key
from duskline.operators.matching import (
    TRIPLE,
    attach_event,
    class_technologies,
    lookup_technology,
    match_to_asset,
    match_triples,
    notice_classes,
    triple_counts,
    wildcard_match,
)
from duskline.operators.rollups import join_counts, technology_rollup
from duskline.operators.skew import HOT_MIN_ROWS, HOT_SHARE, hot_keys, salted_join, tasks_for, total_rows
from duskline.session import ts_lit

# The state of a running resource and of a new impact row.
ACTIVE_STATE = "Succeeded"
OPEN_REMEDIATION = "pendiente"

IMPACT_KEYS = ["date_sk", "asset_sk", "deprecation_sk", "technology_sk"]


def snapshot_columns(as_of: dt.date):
    """(date_sk, snapshot_date) literals of a snapshot day."""
    return F.lit(int(as_of.strftime("%Y%m%d"))), F.lit(as_of.isoformat())


def dim_account(accounts: DataFrame, run_ts) -> DataFrame:
    return accounts.select(
        "account_sk", "account_nk", "cloud_provider", "account_type", "environment", ts_lit(run_ts).alias("loaded_at")
    )


def oldest_asset(assets: DataFrame) -> DataFrame:
    """The first seen row of each natural key."""
    return first_per_key(assets, ["asset_nk"], [F.col("first_seen_at").asc_nulls_last(), F.col("asset_sk").asc()])


def dim_asset(assets: DataFrame, run_ts) -> DataFrame:
    columns = [
        "asset_sk", "asset_nk", "cloud_provider", "account_id", "resource_group", "asset_name", "asset_type", "region",
        "environment", "criticality", "owner_team", "provisioning_state", "sku_name", "sku_tier", "native_resource_id",
        "first_seen_at", "last_seen_at",
    ]
    return oldest_asset(assets).select(*columns, ts_lit(run_ts).alias("loaded_at"))


def dim_technology(technology: DataFrame, run_ts) -> DataFrame:
    """Distinct family, source, name and version under a stable key."""
    columns = ["technology_family", "technology_source", "runtime_name", "runtime_version"]
    return technology.select(*columns).distinct().select(
        hash_key(*columns).alias("technology_sk"),
        *columns,
        F.lit(False).alias("is_deprecated_stub"),
        ts_lit(run_ts).alias("loaded_at"),
    )


def snapshot_flags(df: DataFrame) -> DataFrame:
    """is_active, technology_count (0 when missing) and has_technology."""
    count = F.coalesce("technology_count", F.lit(0)).cast("long")
    return df.withColumns(
        {
            "is_active": F.coalesce(F.col("provisioning_state") == ACTIVE_STATE, F.lit(False)),
            "has_technology": count > 0,
            "technology_count": count,
        }
    )


def fact_inventory(assets: DataFrame, technology: DataFrame, as_of: dt.date, run_ts) -> DataFrame:
    """One row per asset for the snapshot day."""
    day_sk, day = snapshot_columns(as_of)
    rows = snapshot_flags(join_counts(assets, technology_rollup(technology)))
    return rows.select(
        day_sk.alias("date_sk"),
        "asset_sk",
        F.col("account_id").alias("account_nk"),
        "cloud_provider",
        "asset_type",
        "region",
        "environment",
        "criticality",
        "owner_team",
        "provisioning_state",
        "is_active",
        "technology_count",
        "has_technology",
        "technology_families_json",
        "runtime_names_json",
        day.alias("snapshot_date"),
        ts_lit(run_ts).alias("loaded_at"),
    )


def matched_assets(impacted: DataFrame, technology: DataFrame, assets: DataFrame, events: DataFrame) -> DataFrame:
    """Distinct (asset, notice, triple) matches with the dates, severity and status of the notice.

    The event is attached to notices and the asset to technology rows, both
    before the match multiplies them. Each input is made distinct first, so the
    output is distinct without another shuffle.
    """
    notices = impacted.select("deprecation_sk", "technology_family", "affected_runtime", "affected_version").distinct()
    per_asset = match_to_asset(technology.select("resource_id", *TRIPLE), assets)
    per_asset = per_asset.select("resource_id", "asset_sk", *TRIPLE).distinct().drop("resource_id")
    matches = wildcard_match(attach_event(notices, events), per_asset)
    return matches.select("asset_sk", "deprecation_sk", *TRIPLE, "retirement_at", "severity", "status")


def known_triples(technology: DataFrame, dim_tech: DataFrame) -> DataFrame:
    """Distinct technology triples with their key and number of rows."""
    return lookup_technology(triple_counts(technology), dim_tech)


RISK = ["days_to_retirement", "priority", "risk_band_sk", "risk_score"]


def _asking(impacted: DataFrame) -> DataFrame:
    return impacted.select("deprecation_sk", "technology_family", "affected_runtime", "affected_version").distinct()


def notice_exposure(impacted: DataFrame, triples: DataFrame, events: DataFrame, as_of) -> DataFrame:
    """(technology_sk, deprecation_sk) once each, with the risk of the notice as of a day.

    Works on the distinct triples of :func:`known_triples`, never on assets.
    """
    dated = with_risk(attach_event(_asking(impacted), events), as_of)
    covered = match_triples(dated, triples.drop("technology_rows"))
    return covered.select("technology_sk", "deprecation_sk", *RISK).distinct()


def class_exposure(impacted: DataFrame, triples: DataFrame, events: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """(notices, covers), whose join on ``notice_class`` has the rows of :func:`notice_exposure`.

    Notices are one row each with their risk and class, covers one row per class and
    technology. The pairs of notices and technologies are in neither of them.
    """
    asking = _asking(impacted)
    classes = notice_classes(asking)
    dated = with_risk(attach_event(classes, events), as_of).select("notice_class", "deprecation_sk", *RISK).distinct()
    return dated, class_technologies(asking, classes, triples)


def asset_exposure(technology: DataFrame, assets: DataFrame, dim_tech: DataFrame) -> DataFrame:
    """(technology_sk, asset_sk) once each.

    An asset stands for one resource, so rows are made distinct within their
    resource. The lookup shuffles on the folded triple in between.
    """
    rows = lookup_technology(match_to_asset(technology.select("resource_id", *TRIPLE), assets), dim_tech)
    return rows.select("resource_id", "asset_sk", "technology_sk").distinct().drop("resource_id")


def fact_impact(
    impacted: DataFrame,
    technology: DataFrame,
    assets: DataFrame,
    events: DataFrame,
    dim_tech: DataFrame,
    as_of: dt.date,
    run_ts,
    share: float = HOT_SHARE,
    min_rows: int = HOT_MIN_ROWS,
) -> DataFrame:
    """One row per asset, notice and technology for the snapshot day.

    Risk is worked out per notice and the technology key per triple; the only
    join as large as the fact is the last one, on technology_sk, between two
    sides that are distinct already. Technologies many assets share are salted, and the
    number of tasks follows the impacts, which are counted when the plan is made.
    """
    day_sk, day = snapshot_columns(as_of)
    triples = known_triples(technology, dim_tech)
    many = asset_exposure(technology, assets, dim_tech)
    few = notice_exposure(impacted, triples, events, as_of)
    counts = triples.groupBy("technology_sk").agg(F.sum("technology_rows").alias("technology_rows"))
    # What a technology costs is its assets times its notices, which are counted per class first.
    notices, covers = class_exposure(impacted, triples, events, as_of)
    per_class = notices.groupBy("notice_class").agg(F.count(F.lit(1)).alias("n"))
    covered = covers.join(per_class, "notice_class").groupBy("technology_sk").agg(F.sum("n").alias("notices"))
    counts = counts.join(covered, "technology_sk").select("technology_sk", (F.col("technology_rows") * F.col("notices")).alias("impacts"))
    hot = hot_keys(counts, ["technology_sk"], "impacts", share, min_rows)
    tasks = tasks_for(technology.sparkSession, total_rows(counts, "impacts"))
    rows = salted_join(many, few, ["technology_sk"], hot, ["asset_sk"], tasks)
    return rows.select(
        day_sk.alias("date_sk"),
        "asset_sk",
        "deprecation_sk",
        "technology_sk",
        "risk_band_sk",
        "risk_score",
        F.lit(True).alias("is_affected"),
        "days_to_retirement",
        "priority",
        F.lit(OPEN_REMEDIATION).alias("remediation_status"),
        day.alias("snapshot_date"),
        ts_lit(run_ts).alias("loaded_at"),
    )
