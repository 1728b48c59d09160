"""Report queries: group, measure, sort.

Facts are reduced to their foreign keys before they meet a dimension, so a hot
asset or account never travels row by row.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskline.operators.filters import sliced
from duskline.operators.rollups import group_count
from duskline.operators.skew import hot_keys, salted_join, tasks_for
from duskline.operators.star import star_join
from duskline.plans import measures as m
from duskline.plans.gold import OPEN_REMEDIATION
from duskline.plans.kpis import largest


def card(fact: DataFrame, **columns) -> DataFrame:
    """One row of measures over the whole (sliced) fact."""
    return fact.agg(*[c.alias(name) for name, c in columns.items()])


def assets_by(fact: DataFrame, *dims: str, active_only: bool = False) -> DataFrame:
    """Distinct assets by columns of the fact, largest first."""
    rows = fact.filter("is_active") if active_only else fact
    return largest(rows.groupBy(*dims).agg(m.assets().alias("assets")), "assets", *dims)


def rows_by(fact: DataFrame, *dims: str, active_only: bool = False) -> DataFrame:
    """Fact rows by columns of the fact, largest first."""
    rows = fact.filter("is_active") if active_only else fact
    return largest(group_count(rows, *dims, name="asset_rows"), "asset_rows", *dims)


def technologies_by(fact: DataFrame, *dims: str) -> DataFrame:
    return largest(fact.groupBy(*dims).agg(m.technology_total().alias("technologies")), "technologies", *dims)


def asset_table(fact: DataFrame, dim_asset: DataFrame) -> DataFrame:
    """Technologies per asset name with criticality, region and owner of the fact."""
    keys = ["asset_sk", "criticality", "region", "owner_team"]
    per_asset = fact.groupBy(*keys).agg(F.sum("technology_count").alias("technologies"))
    named = star_join(per_asset, (dim_asset, "asset_sk", "asset_sk", {"asset_name": "asset_name"}))
    dims = ["asset_name", "criticality", "region", "owner_team"]
    totals = named.groupBy(*dims).agg(F.sum("technologies").cast("long").alias("technologies"))
    return largest(totals, "technologies", *dims)


def name_bands(df: DataFrame, bands: DataFrame) -> DataFrame:
    """Replace the band key by its name. The dimension has five rows."""
    picked = F.broadcast(bands.select("risk_band_sk", "risk_band_name"))
    return df.join(picked, "risk_band_sk", "left")


def impacts_by_band(impact: DataFrame, bands: DataFrame) -> DataFrame:
    """Impact rows by band name from the fact, counted per band before the join."""
    counts = name_bands(group_count(impact, "risk_band_sk", name="impacts"), bands)
    return largest(counts.groupBy("risk_band_name").agg(F.sum("impacts").alias("impacts")), "impacts", "risk_band_name")


def exposure_by_band(asset_exposure: DataFrame, notices: DataFrame, covers: DataFrame, bands: DataFrame) -> DataFrame:
    """The same report without building the fact."""
    totals = m.exposure_totals(asset_exposure, notices, covers, "risk_band_sk")
    named = name_bands(totals.select("risk_band_sk", "impacts"), bands)
    return largest(named.select("risk_band_name", "impacts"), "impacts", "risk_band_name")


def affected_by_status_priority(impact: DataFrame) -> DataFrame:
    dims = ["remediation_status", "priority"]
    return largest(impact.groupBy(*dims).agg(m.affected_assets().alias("affected_assets")), "affected_assets", *dims)


def exposed_by_priority(asset_exposure: DataFrame, notices: DataFrame, covers: DataFrame) -> DataFrame:
    """Affected assets by status and priority without building the fact: every impact starts out open."""
    pairs = m.exposed_assets(asset_exposure, notices, covers, "priority")
    counts = group_count(pairs, "priority", name="affected_assets")
    dims = ["remediation_status", "priority"]
    named = counts.select(F.lit(OPEN_REMEDIATION).alias("remediation_status"), "priority", "affected_assets")
    return largest(named, "affected_assets", *dims)


ALERT = [
    "asset_name", "environment", "runtime_name", "runtime_version", "days_to_retirement", "priority",
    "remediation_status", "risk_band_name",
]
ALERT_ORDER = ["days_to_retirement", *ALERT[:4]]


# Days that a range of the alert table spans, on average and at least, so that its rows stand for several lines.
DAYS_PER_RANGE = 8


def day_ranges(per_day: list[tuple[int | None, int]], lines_per_range: float) -> list[tuple[int | None, int, bool]]:
    """(day, number of its range, whether it is alone there): days in order, dealt into ranges of so many lines.

    ``per_day`` has (day, lines) once per day. A day with more lines than that has a range of its own, as
    has the missing day, which comes first; the lines of such a day may be split further.
    """
    out, before = [], 0
    for day, lines in sorted(per_day, key=lambda r: (r[0] is not None, r[0])):
        alone = day is None or lines > lines_per_range
        # A day alone comes after the days that begin in its slot, and the next day begins a later slot.
        out.append((day, -1 if day is None else 2 * math.floor(before / lines_per_range) + alone, alone))
        before += lines
    return out


def exposed_alert_table(
    asset_exposure: DataFrame, notices: DataFrame, covers: DataFrame, dim_asset: DataFrame, dim_technology: DataFrame, bands: DataFrame
) -> DataFrame:
    """The alert table without building the fact: notices with equal risk on a technology are one before they meet assets.

    Names are joined to technologies, assets and bands before these meet, so no join moves
    the lines. The order they are shown in begins with the days, which are cut into ranges. Places meet
    the days of a range gathered in one row per technology, priority and band, and these rows are
    dealt by range, not the lines: a line is made where it is shown. Equal lines share a range, so the same
    shuffle serves for making them distinct and for sorting them.
    """
    reasons = m.exposure_reasons(name_bands(notices, bands), covers, "risk_band_name", "days_to_retirement", "priority")
    places = star_join(
        asset_exposure,
        (dim_technology, "technology_sk", "technology_sk", {"runtime_name": "runtime_name", "runtime_version": "runtime_version"}),
        (dim_asset, "asset_sk", "asset_sk", {"asset_name": "asset_name", "environment": "environment"}),
    ).drop("asset_sk").distinct()
    per_technology = places.groupBy("technology_sk").agg(F.count(F.lit(1)).alias("places"))
    costs = per_technology.join(
        reasons.groupBy("technology_sk").agg(F.count(F.lit(1)).alias("reasons")), "technology_sk"
    ).select("technology_sk", (F.col("places") * F.col("reasons")).alias("lines"))
    per_day = reasons.join(per_technology, "technology_sk").groupBy("days_to_retirement").agg(F.sum("places").alias("lines"))
    # One row per day reaches the driver, of which there are as many as the notices' calendar has.
    spark, counted = places.sparkSession, [(r[0], r[1]) for r in per_day.collect()]
    total = sum(n for _, n in counted)
    tasks = tasks_for(spark, total)
    ranges = min(4 * tasks, max(4 * spark.sparkContext.defaultParallelism, len(counted) // DAYS_PER_RANGE))
    dated = F.broadcast(spark.createDataFrame(day_ranges(counted, max(1.0, total / ranges)), "__day int, __range long, __alone boolean"))
    packed = reasons.join(dated, F.col("days_to_retirement").eqNullSafe(F.col("__day"))).groupBy(
        "technology_sk", "priority", "risk_band_name", "__range", "__alone"
    ).agg(F.collect_list("days_to_retirement").alias("__days"))
    hot = hot_keys(costs, ["technology_sk"], "lines")
    met = salted_join(places, packed, ["technology_sk"], hot, ["asset_name", "environment"], tasks)
    split = {f"__{c}": F.when(F.col("__alone"), F.col(c)) for c in ALERT_ORDER[1:]}
    dealt = ["__range", *split]
    met = met.withColumns(split).select(*dealt, *ALERT_ORDER[1:], "priority", "risk_band_name", "__days")
    # A range is held whole while its lines are made distinct and sorted. The missing day is an empty list.
    met = met.repartitionByRange(4 * ranges, *dealt)
    lines = met.select("*", F.explode_outer("__days").alias("days_to_retirement")).drop("__days")
    lines = lines.distinct().drop(*dealt).sortWithinPartitions(*ALERT_ORDER)
    return lines.withColumn("remediation_status", F.lit(OPEN_REMEDIATION)).select(*ALERT)


def alert_table(impact: DataFrame, dim_asset: DataFrame, dim_technology: DataFrame, bands: DataFrame) -> DataFrame:
    """Distinct alert lines, most urgent first. Notices with equal lines collapse before the joins."""
    lines = impact.select(
        "asset_sk", "technology_sk", "risk_band_sk", "days_to_retirement", "priority", "remediation_status"
    ).distinct()
    return _alert_lines(lines, dim_asset, dim_technology, bands)


def _alert_lines(lines: DataFrame, dim_asset: DataFrame, dim_technology: DataFrame, bands: DataFrame) -> DataFrame:
    joined = star_join(
        name_bands(lines, bands),
        (dim_technology, "technology_sk", "technology_sk", {"runtime_name": "runtime_name", "runtime_version": "runtime_version"}),
        (dim_asset, "asset_sk", "asset_sk", {"asset_name": "asset_name", "environment": "environment"}),
    )
    return joined.select(*ALERT).distinct().orderBy(*ALERT_ORDER)


def slicer_values(df: DataFrame, column: str) -> DataFrame:
    """The choices a slicer offers."""
    return df.select(column).distinct().orderBy(column)


def sliced_report(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, selection: dict, dims: list[str]) -> DataFrame:
    """Rows of a fact by ``dims`` under a dimension slicer, which is applied to the dimension first."""
    chosen = sliced(dim, **selection).select(F.col(dim_key).alias(fact_key)).distinct()
    return group_count(fact.join(chosen, fact_key, "left_semi"), *dims, name="asset_rows")
