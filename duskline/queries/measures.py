"""The sixteen measures, by shared dimensions.

Measures over the impact fact are worked out from exposure counts wherever that
is possible, so the fact is not built for them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from duskline.plans import measures as m
from duskline.queries import entities as e
from duskline.queries.registry import query


@query("m_assets", "SELECT environment, count(DISTINCT asset_sk) AS assets FROM inventory GROUP BY 1")
def m_assets(spark, sf):
    return e.inventory(spark, sf).groupBy("environment").agg(m.assets().alias("assets"))


@query("m_active_assets", "SELECT cloud_provider, count(DISTINCT asset_sk) FILTER (is_active) AS active_assets FROM inventory GROUP BY 1")
def m_active_assets(spark, sf):
    return e.inventory(spark, sf).groupBy("cloud_provider").agg(m.active_assets().alias("active_assets"))


@query("m_tech_count", "SELECT account_nk, CAST(sum(technology_count) AS BIGINT) AS technologies FROM inventory GROUP BY 1")
def m_tech_count(spark, sf):
    return e.inventory(spark, sf).groupBy("account_nk").agg(m.technology_total().alias("technologies"))


@query("m_impacts", "SELECT priority, count(*) AS impacts FROM impact GROUP BY 1")
def m_impacts(spark, sf):
    return m.exposure_totals(*e.exposures(spark, sf), "priority").select("priority", "impacts")


@query("m_impacts_by_technology", "SELECT technology_sk, count(*) AS impacts FROM impact GROUP BY 1")
def m_impacts_by_technology(spark, sf):
    return m.exposure_totals(*e.exposures(spark, sf), "technology_sk").select("technology_sk", "impacts")


@query("m_affected_assets", "SELECT priority, count(DISTINCT asset_sk) AS affected_assets FROM impact WHERE is_affected GROUP BY 1")
def m_affected_assets(spark, sf):
    exposed = m.exposed_assets(*e.exposures(spark, sf), "priority")
    return exposed.groupBy("priority").agg(F.count(F.lit(1)).alias("affected_assets"))


@query(
    "m_affected_assets_fact",
    "SELECT remediation_status, count(DISTINCT asset_sk) FILTER (is_affected) AS affected_assets FROM impact GROUP BY 1",
)
def m_affected_assets_fact(spark, sf):
    return e.impact(spark, sf).groupBy("remediation_status").agg(m.affected_assets().alias("affected_assets"))


_PCT = """
    SELECT {by} count(DISTINCT i.asset_sk) AS assets, count(DISTINCT x.asset_sk) AS affected_assets,
           count(DISTINCT x.asset_sk) / count(DISTINCT i.asset_sk) AS affected_share
    FROM inventory i LEFT JOIN (SELECT DISTINCT asset_sk FROM impact) x ON x.asset_sk = i.asset_sk {group}
"""


@query("m_pct_affected", _PCT.format(by="i.region AS region,", group="GROUP BY i.region"))
def m_pct_affected(spark, sf):
    """Region is an attribute of the asset, which both facts share."""
    region = e.assets(spark, sf).select("asset_sk", "region")
    hit = m.exposed_assets(*e.exposures(spark, sf)).withColumn("is_affected", F.lit(True)).join(region, "asset_sk")
    return m.affected_share(e.inventory(spark, sf), hit, ["region"])


def totals(spark, sf, *columns):
    return m.exposure_totals(*e.exposures(spark, sf), "risk_band_sk").select("risk_band_sk", *columns)


@query("m_avg_risk", "SELECT risk_band_sk, round(avg(risk_score), 6) AS average_risk FROM impact GROUP BY 1")
def m_avg_risk(spark, sf):
    return totals(spark, sf, F.round("average_risk", 6).alias("average_risk"))


@query("m_avg_days", "SELECT risk_band_sk, round(avg(days_to_retirement), 6) AS average_days FROM impact GROUP BY 1")
def m_avg_days(spark, sf):
    return totals(spark, sf, F.round("average_days", 6).alias("average_days"))


@query("m_critical_alerts", "SELECT priority, count_if(risk_band_sk = '1') AS critical_alerts FROM impact GROUP BY 1")
def m_critical_alerts(spark, sf):
    return m.exposure_totals(*e.exposures(spark, sf), "priority").select("priority", "critical_alerts")


@query("m_affected_techs", "SELECT risk_band_sk, count(DISTINCT technology_sk) AS affected_technologies FROM impact GROUP BY 1")
def m_affected_techs(spark, sf):
    return totals(spark, sf, "affected_technologies")


@query("m_min_days", "SELECT risk_band_sk, min(days_to_retirement) FILTER (days_to_retirement > 0) AS nearest_days FROM impact GROUP BY 1")
def m_min_days(spark, sf):
    return totals(spark, sf, "nearest_days")


@query("m_notices", "SELECT technology_family, count(*) AS notices FROM event GROUP BY 1")
def m_notices(spark, sf):
    return e.events(spark, sf).groupBy("technology_family").agg(m.notices().alias("notices"))


@query("m_critical_notices", "SELECT technology_family, count_if(severity = 'critical') AS critical_notices FROM event GROUP BY 1")
def m_critical_notices(spark, sf):
    return e.events(spark, sf).groupBy("technology_family").agg(m.critical_notices().alias("critical_notices"))


@query(
    "m_due_90d",
    "SELECT status, count_if(retirement_at >= DATE '1998-01-01' AND retirement_at <= DATE '1998-01-01' + 90) AS due_90d FROM event GROUP BY 1",
)
def m_due_90d(spark, sf):
    return e.notices(spark, sf).groupBy("status").agg(m.due_soon(e.AS_OF).alias("due_90d"))


@query("m_overdue", "SELECT severity, count_if(retirement_at < DATE '1998-01-01') AS overdue FROM event GROUP BY 1")
def m_overdue(spark, sf):
    return e.events(spark, sf).groupBy("severity").agg(m.overdue(e.AS_OF).alias("overdue"))


@query(
    "m_next_retirement",
    "SELECT technology_family, strftime(min(retirement_at) FILTER (retirement_at >= DATE '1998-01-01'), '%Y-%m-%d') AS next_retirement FROM event GROUP BY 1",
)
def m_next_retirement(spark, sf):
    nearest = m.next_retirement(e.AS_OF)
    rows = e.events(spark, sf).groupBy("technology_family").agg(nearest.alias("at"))
    return rows.select("technology_family", F.date_format("at", "yyyy-MM-dd").alias("next_retirement"))
