"""Inventory KPIs over the dimensions and the snapshot fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskline.operators.rollups import group_count, row_count


def largest(df: DataFrame, measure: str, *keys: str, n: int | None = None) -> DataFrame:
    """Groups by measure, largest first, ties by key; ``n`` for a report that shows only the first."""
    ordered = df.orderBy(F.desc(measure), *[F.col(k).asc_nulls_first() for k in keys])
    return ordered if n is None else ordered.limit(n)


def assets_by_type(assets: DataFrame) -> DataFrame:
    return group_count(assets, "cloud_provider", "asset_type", name="total_assets")


def environment_distribution(assets: DataFrame) -> DataFrame:
    """Assets, teams and regions per environment; counted once per combination before anything is made distinct."""
    combined = assets.groupBy("environment", "owner_team", "region").agg(row_count("assets"))
    return combined.groupBy("environment").agg(
        F.sum("assets").alias("total_assets"),
        F.count_distinct("owner_team").alias("teams"),
        F.count_distinct("region").alias("regions"),
    )


def technology_usage(assets: DataFrame, technology: DataFrame) -> DataFrame:
    """Assets by technology; assets without one form a group of nulls.

    Technology rows are counted per resource and triple before they meet the
    assets.
    """
    triple = ["technology_family", "runtime_name", "runtime_version"]
    per_resource = technology.groupBy(F.col("resource_id").alias("native_resource_id"), *triple).agg(row_count("__n"))
    joined = assets.select("native_resource_id").join(per_resource, "native_resource_id", "left")
    return joined.groupBy(*triple).agg(F.sum(F.coalesce("__n", F.lit(1))).cast("long").alias("total_assets"))


def criticality_coverage(fact: DataFrame) -> DataFrame:
    """Assets by criticality with and without a detected technology."""
    has = F.col("has_technology")
    return fact.groupBy("criticality").agg(
        row_count("total_assets"),
        F.count_if(has).alias("with_technology"),
        F.count_if(~has).alias("without_technology"),
    )


def assets_by_region(assets: DataFrame) -> DataFrame:
    return group_count(assets, "region", name="total_assets")


def assets_without_technology(fact: DataFrame) -> DataFrame:
    return group_count(fact.filter(~F.col("has_technology")), "asset_type", "environment", name="total_assets")


def owner_rollup(assets: DataFrame) -> DataFrame:
    return assets.groupBy("owner_team").agg(row_count("total_assets"), F.count_distinct("asset_type").alias("asset_types"))


def due_windows(impact: DataFrame, windows: tuple[int, ...] = (30, 60, 90)) -> DataFrame:
    """Assets affected on the day (retirement reached) and due within each window of days."""
    days = F.col("days_to_retirement")
    tests = {"affected_now": days <= 0} | {f"due_{w}d": (days > 0) & (days <= w) for w in windows}
    # One row per asset with a flag per window, so the rows are not multiplied by the windows.
    per_asset = impact.filter(F.col("asset_sk").isNotNull()).groupBy("asset_sk").agg(*[F.bool_or(t).alias(n) for n, t in tests.items()])
    return per_asset.agg(*[F.count_if(F.col(n)).alias(n) for n in tests])
