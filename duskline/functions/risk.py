"""Time to retirement, severity, priority, band and score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from duskline.functions.text import first_label
from duskline.session import date_lit

# Day limits with the level they give, and the score of each band.
DAY_LIMITS = ((30, "critical"), (90, "high"), (180, "medium"))
BEYOND_LIMITS = "low"
UNDATED_SEVERITY = "medium"
BAND_OF_LEVEL = (("critical", "1"), ("high", "2"), ("medium", "3"), ("low", "4"))
BAND_SCORES = (("1", 1.0), ("2", 0.75), ("3", 0.5), ("4", 0.25))


def days_to_retirement(retirement: Column | str, as_of) -> Column:
    """Whole days from ``as_of`` to the retirement day; negative once it has passed."""
    retirement = F.col(retirement) if isinstance(retirement, str) else retirement
    return F.date_diff(retirement.cast("date"), date_lit(as_of))


def severity(status: Column, days: Column) -> Column:
    """Severity from a folded status and the days left."""
    rules = [(status == "retired", "critical"), (days.isNull(), UNDATED_SEVERITY)]
    rules += [(days <= limit, level) for limit, level in DAY_LIMITS]
    return first_label(rules, BEYOND_LIMITS)


def priority(severity_label: Column) -> Column:
    """Severity folded to the four priorities; anything unknown is low."""
    known = [level for _, level in DAY_LIMITS]
    folded = F.lower(severity_label)
    return F.coalesce(F.when(folded.isin(known), folded), F.lit(BEYOND_LIMITS))


def risk_band(days: Column, priority_label: Column) -> Column:
    """Band '1' to '4': the worse of what the days and the priority say."""
    by_days = first_label([(days <= limit, band) for (limit, _), (_, band) in zip(DAY_LIMITS, BAND_OF_LEVEL)], "4")
    folded = F.lower(priority_label)
    by_priority = first_label([(folded == level, band) for level, band in BAND_OF_LEVEL], "4")
    return F.least(by_days, by_priority)


def risk_score(band: Column) -> Column:
    """Score of a band, 0.0 for any other."""
    return F.coalesce(*[F.when(band == b, F.lit(s)) for b, s in BAND_SCORES], F.lit(0.0))


def with_risk(df, as_of, retirement: str = "retirement_at", severity_col: str = "severity"):
    """Add days_to_retirement, priority, risk_band_sk and risk_score to a frame of dated notices."""
    return (
        df.withColumn("days_to_retirement", days_to_retirement(retirement, as_of))
        .withColumn("priority", priority(F.col(severity_col)))
        .withColumn("risk_band_sk", risk_band(F.col("days_to_retirement"), F.col("priority")))
        .withColumn("risk_score", risk_score(F.col("risk_band_sk")))
    )
