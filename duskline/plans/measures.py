"""The measures of the model as aggregate columns, and the exposure measures without the fact.

An aggregate over no rows gives 0 for counts and null for the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskline.session import date_lit

CRITICAL_BAND = "1"
DUE_DAYS = 90


def _distinct(value: Column, blank_counts: bool = False) -> Column:
    """Distinct values; ``blank_counts`` adds one when a null occurs, as the model's DISTINCTCOUNT does."""
    counted = F.count_distinct(value)
    if blank_counts:
        counted = counted + F.coalesce(F.max(value.isNull().cast("long")), F.lit(0))
    return counted


# -- inventory ----------------------------------------------------------------
def assets() -> Column:
    return _distinct(F.col("asset_sk"), blank_counts=True)


def active_assets() -> Column:
    return _distinct(F.when(F.col("is_active"), F.col("asset_sk")))


def technology_total() -> Column:
    return F.sum("technology_count").cast("long")


# -- impact -------------------------------------------------------------------
def impacts() -> Column:
    return F.count(F.lit(1))


def affected_assets() -> Column:
    return _distinct(F.when(F.col("is_affected"), F.col("asset_sk")))


def average_risk() -> Column:
    return F.avg("risk_score")


def average_days() -> Column:
    return F.avg("days_to_retirement")


def critical_alerts() -> Column:
    return F.count_if(F.col("risk_band_sk") == CRITICAL_BAND)


def affected_technologies() -> Column:
    return _distinct(F.col("technology_sk"), blank_counts=True)


def nearest_days() -> Column:
    return F.min(F.when(F.col("days_to_retirement") > 0, F.col("days_to_retirement")))


def affected_share(inventory: DataFrame, impact: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Affected assets over all assets, in total or by dimensions both facts share.

    Each fact is aggregated by itself first, so neither filters the other; no
    assets gives null.
    """
    by = by or []
    stock = inventory.groupBy(*by).agg(assets().alias("assets"))
    hit = impact.groupBy(*by).agg(affected_assets().alias("affected_assets"))
    if by:
        hit = hit.select(*[F.col(c).alias(f"__{c}") for c in by], "affected_assets")
        on = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
        both = stock.join(hit, on, "full_outer")
        counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("assets", "affected_assets")]
        both = both.select(*[F.coalesce(c, f"__{c}").alias(c) for c in by], *counts)
    else:
        # One row on each side: the second is read as a scalar subquery.
        both = stock.withColumn("affected_assets", hit.scalar())
    return both.withColumn("affected_share", F.try_divide(F.col("affected_assets"), F.col("assets")))


# -- notices ------------------------------------------------------------------
def notices() -> Column:
    return F.count(F.lit(1))


def critical_notices() -> Column:
    return F.count_if(F.col("severity") == "critical")


def due_soon(as_of, days: int = DUE_DAYS) -> Column:
    day = date_lit(as_of)
    return F.count_if(F.col("retirement_at").cast("timestamp_ntz").between(day, F.date_add(day, days)))


def overdue(as_of) -> Column:
    return F.count_if(F.col("retirement_at").cast("timestamp_ntz") < date_lit(as_of))


def next_retirement(as_of) -> Column:
    at = F.col("retirement_at").cast("timestamp_ntz")
    return F.min(F.when(at >= date_lit(as_of), at))


# -- exposure: impact measures without building the fact ------------------------
def per_technology(asset_exposure: DataFrame) -> DataFrame:
    """Assets on each technology."""
    return asset_exposure.groupBy("technology_sk").agg(F.count(F.lit(1)).alias("asset_rows"))


def exposure_totals(asset_exposure: DataFrame, notices: DataFrame, covers: DataFrame, *by: str) -> DataFrame:
    """Impact rows, risk and days per ``by`` (columns of the notices, or ``technology_sk``), from counts.

    ``notices`` and ``covers`` are those of ``gold.class_exposure``. The fact has one
    row per asset and notice on the same technology, so a group of it is the sum over
    technologies and notice classes of (assets x notices). Notices are summed per class
    and ``by``, assets per technology, before they meet: the joins have one row per
    covered technology, class and ``by``, whatever the number of notices or impacts.
    """
    keys = ["notice_class", *[c for c in by if c != "technology_sk"]]
    notice_side = notices.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("risk_score").alias("score"),
        F.sum("days_to_retirement").alias("days"),
        F.count("days_to_retirement").alias("dated"),
        F.count_if(F.col("risk_band_sk") == CRITICAL_BAND).alias("critical"),
        F.min(F.when(F.col("days_to_retirement") > 0, F.col("days_to_retirement"))).alias("nearest"),
    )
    met = covers.join(per_technology(asset_exposure), "technology_sk").join(notice_side, "notice_class")
    rows = F.col("asset_rows")
    total = lambda c: F.coalesce(F.sum(F.col(c) * rows), F.lit(0))
    return met.groupBy(*by).agg(
        total("n").cast("long").alias("impacts"),
        F.try_divide(F.sum(F.col("score") * rows), F.sum(F.col("n") * rows)).alias("average_risk"),
        F.try_divide(F.sum(F.col("days") * rows), F.sum(F.col("dated") * rows)).alias("average_days"),
        total("critical").cast("long").alias("critical_alerts"),
        F.min("nearest").alias("nearest_days"),
        F.count_distinct("technology_sk").alias("affected_technologies"),
    )


def exposure_reasons(notices: DataFrame, covers: DataFrame, *by: str) -> DataFrame:
    """Distinct (technology, ``by``): notices are made distinct per class before they meet its technologies."""
    if not by:
        return covers.select("technology_sk").distinct()
    few = notices.select("notice_class", *by).distinct()
    return covers.join(few, "notice_class").select("technology_sk", *by).distinct()


def exposed_assets(asset_exposure: DataFrame, notices: DataFrame, covers: DataFrame, *by: str) -> DataFrame:
    """Distinct (asset, ``by``) pairs with at least one impact.

    The notice side is reduced to distinct (technology, ``by``) before the join,
    so an asset meets each combination once however many notices stand behind it.
    """
    reasons = exposure_reasons(notices, covers, *by)
    if not by:
        return asset_exposure.join(reasons, "technology_sk", "left_semi").select("asset_sk").distinct()
    return asset_exposure.join(reasons, "technology_sk").select("asset_sk", *by).distinct()
