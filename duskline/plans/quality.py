"""Data-quality checks. Each returns the offending rows or a small summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskline.operators.dedupe import repeated_keys
from duskline.operators.rollups import null_counts
from duskline.operators.star import without_technology

UNKNOWN = "unknown"


class EmptySource(RuntimeError):
    """A required source is missing or has no rows."""


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """The frame itself, or an error when it has no rows (reads one row at most)."""
    if df.isEmpty():
        raise EmptySource(f"{name} has no rows")
    return df


def require_tables(store, names: list[str]) -> None:
    missing = store.missing(names)
    if missing:
        raise EmptySource(f"missing tables: {', '.join(missing)}")


def duplicate_assets(assets: DataFrame) -> DataFrame:
    return repeated_keys(assets, ["asset_nk"])


def asset_nulls(assets: DataFrame) -> DataFrame:
    return null_counts(assets, "asset_type", "cloud_provider")


def unmatched_assets(assets: DataFrame, technology: DataFrame) -> DataFrame:
    return without_technology(assets, technology)


def null_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Rows with a null in any business key."""
    test = F.lit(False)
    for key in keys:
        test = test | F.col(key).isNull()
    return df.filter(test)


def unclassified_notices(notices: DataFrame, class_col: str = "notice_class") -> DataFrame:
    return notices.filter(F.col(class_col) == "unclassified")


def without_owner_or_criticality(assets: DataFrame) -> DataFrame:
    missing = lambda c: F.coalesce(F.col(c), F.lit(UNKNOWN)) == UNKNOWN
    return assets.filter(missing("owner_team") | missing("criticality"))


def invalid_retirement_dates(notices: DataFrame) -> DataFrame:
    """Notices whose retirement text is not a date, or lies before the publication."""
    unreadable = F.col("retire_date").isNotNull() & F.try_to_date("retire_date").isNull()
    early = F.col("retirement_at") < F.col("published_at")
    return notices.filter(unreadable | F.coalesce(early, F.lit(False)))


def orphan_keys(fact: DataFrame, key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Fact keys that are missing from the dimension, with their row count.

    Counted per key before the join, so only distinct keys are shuffled to it.
    """
    keys = fact.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("row_count"))
    return keys.join(dim.select(F.col(dim_key).alias("key")).distinct(), "key", "left_anti")


def critical_rows(impact: DataFrame, bands: DataFrame) -> DataFrame:
    """Impact rows of the band named 'critical'."""
    wanted = bands.filter(F.col("risk_band_name") == "critical").select("risk_band_sk")
    return impact.join(F.broadcast(wanted), "risk_band_sk", "left_semi")
