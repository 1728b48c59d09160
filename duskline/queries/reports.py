"""The report visuals: group, measure, sort."""

from __future__ import annotations

from pyspark.sql import functions as F

from duskline.plans import measures as m
from duskline.plans import reports
from duskline.queries import entities as e
from duskline.queries.registry import query, table
from duskline.sources import reference


@query("rpt_assets_card", "SELECT count(DISTINCT asset_sk) AS assets FROM inventory")
def rpt_assets_card(spark, sf):
    return reports.card(e.inventory(spark, sf), assets=m.assets())


@query("rpt_active_card", "SELECT count(DISTINCT asset_sk) AS active_assets FROM inventory WHERE is_active")
def rpt_active_card(spark, sf):
    return reports.card(e.inventory(spark, sf), active_assets=m.active_assets())


@query("rpt_assets_by_provider", "SELECT cloud_provider, count(DISTINCT asset_sk) AS assets FROM inventory GROUP BY 1 ORDER BY 2 DESC, 1")
def rpt_assets_by_provider(spark, sf):
    return reports.assets_by(e.inventory(spark, sf), "cloud_provider")


@query("rpt_rows_by_crit_env", "SELECT criticality, environment, count(*) AS asset_rows FROM inventory GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2")
def rpt_rows_by_crit_env(spark, sf):
    return reports.rows_by(e.inventory(spark, sf), "criticality", "environment")


@query(
    "rpt_tech_by_crit_provider",
    "SELECT criticality, cloud_provider, CAST(sum(technology_count) AS BIGINT) AS technologies FROM inventory GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2",
)
def rpt_tech_by_crit_provider(spark, sf):
    return reports.technologies_by(e.inventory(spark, sf), "criticality", "cloud_provider")


@query(
    "rpt_asset_table",
    """
    SELECT a.asset_name, i.criticality, i.region, i.owner_team, CAST(sum(i.technology_count) AS BIGINT) AS technologies
    FROM inventory i LEFT JOIN asset a USING (asset_sk) GROUP BY 1, 2, 3, 4
    """,
)
def rpt_asset_table(spark, sf):
    return reports.asset_table(e.inventory(spark, sf), e.assets(spark, sf))


@query("rpt_active_by_env", "SELECT environment, count(*) AS asset_rows FROM inventory WHERE is_active GROUP BY 1 ORDER BY 2 DESC, 1")
def rpt_active_by_env(spark, sf):
    return reports.rows_by(e.inventory(spark, sf), "environment", active_only=True)


@query("rpt_active_by_provider", "SELECT cloud_provider, count(DISTINCT asset_sk) AS assets FROM inventory WHERE is_active GROUP BY 1 ORDER BY 2 DESC, 1")
def rpt_active_by_provider(spark, sf):
    return reports.assets_by(e.inventory(spark, sf), "cloud_provider", active_only=True)


@query(
    "rpt_active_by_crit_env",
    "SELECT criticality, environment, count(*) AS asset_rows FROM inventory WHERE is_active GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2",
)
def rpt_active_by_crit_env(spark, sf):
    return reports.rows_by(e.inventory(spark, sf), "criticality", "environment", active_only=True)


@query("rpt_total_card", "SELECT count(DISTINCT asset_sk) AS assets FROM inventory")
def rpt_total_card(spark, sf):
    return reports.card(e.inventory(spark, sf), assets=m.assets())


_BAND = "CASE risk_band_sk WHEN '1' THEN 'critical' WHEN '2' THEN 'high' WHEN '3' THEN 'medium' WHEN '4' THEN 'low' END AS risk_band_name"


@query("rpt_impacts_by_band", f"SELECT {_BAND}, count(*) AS impacts FROM impact GROUP BY 1 ORDER BY 2 DESC, 1")
def rpt_impacts_by_band(spark, sf):
    return reports.exposure_by_band(*e.exposures(spark, sf), reference.dim_risk_band(spark))


@query("rpt_impacts_by_band_fact", f"SELECT {_BAND}, count(*) AS impacts FROM impact GROUP BY 1 ORDER BY 2 DESC, 1")
def rpt_impacts_by_band_fact(spark, sf):
    """The same report over the built fact."""
    return reports.impacts_by_band(e.impact(spark, sf), reference.dim_risk_band(spark))


@query(
    "rpt_affected_by_status_priority",
    "SELECT remediation_status, priority, count(DISTINCT asset_sk) AS affected_assets FROM impact WHERE is_affected GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2",
)
def rpt_affected_by_status_priority(spark, sf):
    return reports.exposed_by_priority(*e.exposures(spark, sf))


@query(
    "rpt_alert_table",
    f"""
    SELECT DISTINCT a.asset_name, a.environment, d.runtime_name, d.runtime_version, i.days_to_retirement, i.priority,
           i.remediation_status, {_BAND}
    FROM impact i LEFT JOIN asset a USING (asset_sk) LEFT JOIN dim_tech d USING (technology_sk)
    """,
)
def rpt_alert_table(spark, sf):
    return reports.exposed_alert_table(
        *e.exposures(spark, sf), e.assets(spark, sf), e.dim_technology(spark, sf), reference.dim_risk_band(spark)
    )


@query("rpt_affected_card", "SELECT count(DISTINCT asset_sk) AS affected_assets FROM impact WHERE is_affected")
def rpt_affected_card(spark, sf):
    exposed = m.exposed_assets(*e.exposures(spark, sf))
    return exposed.agg(F.count(F.lit(1)).alias("affected_assets"))


@query(
    "rpt_pct_card",
    """
    SELECT (SELECT count(DISTINCT asset_sk) FROM inventory) AS assets, (SELECT count(DISTINCT asset_sk) FROM impact) AS affected_assets,
           (SELECT count(DISTINCT asset_sk) FROM impact) / (SELECT count(DISTINCT asset_sk) FROM inventory) AS affected_share
    """,
)
def rpt_pct_card(spark, sf):
    hit = m.exposed_assets(*e.exposures(spark, sf)).withColumn("is_affected", F.lit(True))
    return m.affected_share(e.inventory(spark, sf), hit)


@query("rpt_slicer_values", "SELECT DISTINCT environment FROM inventory ORDER BY 1")
def rpt_slicer_values(spark, sf):
    return reports.slicer_values(e.inventory(spark, sf), "environment")


@query(
    "rpt_slicers",
    """
    SELECT cloud_provider, criticality, count(*) AS asset_rows FROM inventory WHERE asset_sk IN
        (SELECT asset_sk FROM asset WHERE environment IN ('production', 'staging')) GROUP BY 1, 2
    """,
)
def rpt_slicers(spark, sf):
    return reports.sliced_report(
        e.inventory(spark, sf), e.assets(spark, sf), "asset_sk", "asset_sk",
        {"environment": ["production", "staging"]}, ["cloud_provider", "criticality"],
    )


@query(
    "rpt_due_by_year",
    """
    SELECT year(l_shipdate)::INTEGER AS year, quarter(l_shipdate)::INTEGER AS quarter, count(*) AS asset_rows FROM lineitem GROUP BY 1, 2
    """,
)
def rpt_due_by_year(spark, sf):
    """A fact by calendar attributes: counted per day before it meets the calendar."""
    from duskline.functions.keys import date_sk
    from duskline.operators.star import star_join

    days = table(spark, sf, "lineitem").groupBy(date_sk("l_shipdate").alias("date_sk")).agg(F.count(F.lit(1)).alias("n"))
    ship = table(spark, sf, "lineitem").agg(
        F.min("l_shipdate").cast("date").alias("first_day"), F.max("l_shipdate").cast("date").alias("last_day")
    )
    calendar = reference.calendar_attributes(reference.days_between(ship))
    named = star_join(days, (calendar, "date_sk", "date_sk", {"year": "year", "quarter": "quarter"}))
    return named.groupBy("year", "quarter").agg(F.sum("n").alias("asset_rows"))
