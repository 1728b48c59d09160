"""Column functions on hand-written rows."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from duskline.functions import keys, normalize, risk, text

AS_OF = dt.date(2026, 1, 1)


def values(spark, inputs, build, ddl="v string"):
    df = spark.createDataFrame([(i, *(x if isinstance(x, tuple) else (x,))) for i, x in enumerate(inputs)], "i int, " + ddl)
    return [r[0] for r in df.orderBy("i").select(build().alias("out")).collect()]


# An independent reading of the date rule, one text at a time.
MONTHS = {m: i + 1 for i, m in enumerate(text.MONTHS)}


def expected_date(body):
    found = []
    names = "|".join(MONTHS)
    for pattern, order in (
        (rf"\b(\d{{1,2}})(?:st|nd|rd|th)?\s+({names})\s+(\d{{4}})\b", (0, 1, 2)),
        (rf"\b({names})\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})\b", (1, 0, 2)),
    ):
        m = re.search(pattern, body or "", re.IGNORECASE)
        if m:
            day, month, year = (m.groups()[i] for i in order)
            try:
                found.append((m.start(), dt.date(int(year), MONTHS[month.lower()], int(day))))
            except ValueError:
                pass
    return min(found)[1] if found else None


DATE_TEXTS = [
    ("Retirement: X will retire on 1 October 2026", dt.date(2026, 10, 1)),
    ("gone by March 31st, 2028", dt.date(2028, 3, 31)),
    ("October 1, 2026 and then 30 June 2027", dt.date(2026, 10, 1)),
    ("30 February 2026, later 1 May 2026", None),
    ("31 June 2026, or June 3 2026", dt.date(2026, 6, 3)),
    ("June 31, 2026 or 3 June 2027", dt.date(2027, 6, 3)),
    ("X is retiring", None),
    ("1st  OCTOBER 2026", dt.date(2026, 10, 1)),
    ("12 May2026 and 112 May 2026", None),
    ("May 10 2026", dt.date(2026, 5, 10)),
    ("0 May 2026", None),
    ("5 May 0000", None),
    ("10th,  May 2026 May 11,2026 x May 11th, 2027", dt.date(2027, 5, 11)),
    ("é1 May 2026", None),
    ("a1 May 2026, 11 May 2026", dt.date(2026, 5, 11)),
    ("may 2026", None),
    ("29 February 2024", dt.date(2024, 2, 29)),
    ("", None),
    (None, None),
]


def test_retire_date(spark):
    bodies = [b for b, _ in DATE_TEXTS]
    assert [expected_date(b) for b in bodies] == [d for _, d in DATE_TEXTS]
    assert values(spark, bodies, lambda: text.retire_date("v")) == [d for _, d in DATE_TEXTS]


piece = st.sampled_from(
    ["1 May 2026", "May 1, 2026", "31 June 2026", "June 31st 2026", "3rd march 2027", "December 12,  1999", "may", "2026", "30 FEBRUARY 2024",
     "x", ",", "12", "th", "February 29, 2024", "\n"]
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(piece, max_size=6), min_size=20, max_size=60), st.sampled_from([" ", ""]))
def test_retire_date_equals_rule(spark, parts, gap):
    bodies = [gap.join(p) for p in parts]
    assert values(spark, bodies, lambda: text.retire_date("v")) == [expected_date(b) for b in bodies]


def test_status_label(spark):
    given_ = [None, "  ", "Retired", "Will retire", "now DEPRECATED", "Public Preview", " Launched "]
    want = ["unknown", "unknown", "retired", "retiring", "deprecated", "preview", "launched"]
    assert values(spark, given_, lambda: text.status_label("v")) == want


def test_technology_family_order(spark):
    given_ = ["AKS on VM", "Azure Functions", "MySQL files", "user profiles", "central us", "DNS zone", "nothing", None, "vmware"]
    want = ["containers", "compute", "data", "storage", "security", "network", "platform", "platform", "compute"]
    assert values(spark, given_, lambda: text.technology_family(F.lit(None), F.lit(""), "v")) == want


def test_impact_scope(spark):
    given_ = [("s", "f", "r", "v"), ("s", "f", " ", "v"), ("s", None, None, "1"), ("s", "", None, " "), (None, None, None, None)]
    want = ["runtime", "feature", "runtime", "service", "configuration"]
    got = values(spark, given_, lambda: text.impact_scope("s", "f", "r", "v"), "s string, f string, r string, v string")
    assert got == want


def test_mentions_retirement(spark):
    given_ = ["Retirement of X", "is deprecated", "unretired", None, "retir it"]
    assert values(spark, given_, lambda: text.mentions_retirement("v")) == [True, True, False, False, True]
    assert values(spark, given_, lambda: text.mentions_retirement("v", whole_term=True)) == [False, False, False, False, True]


def test_notice_class(spark):
    given_ = [("Key Vault", None), ("Python 3", "Functions v4"), ("Python", "app"), (None, None)]
    want = ["azure.key_vault", "azure.functions.python", "unclassified", "unclassified"]
    assert values(spark, given_, lambda: text.notice_class("t", "s"), "t string, s string") == want


@pytest.mark.parametrize(
    ("days", "severity", "band"),
    [(-1, "critical", "1"), (0, "critical", "1"), (30, "critical", "1"), (31, "high", "2"), (90, "high", "2"), (91, "medium", "3"),
     (180, "medium", "3"), (181, "low", "4"), (None, "medium", "4")],
)
def test_severity_and_band_limits(spark, days, severity, band):
    d = F.lit(days).cast("int")
    row = spark.range(1).select(
        risk.severity(F.lit("open"), d), risk.severity(F.lit("retired"), d), risk.risk_band(d, F.lit("low")),
        risk.risk_band(d, F.lit("Critical")), risk.risk_band(F.lit(None).cast("int"), F.lit("high")),
    ).first()
    assert tuple(row) == (severity, "critical", band, "1", "2")


def test_scores_and_priority(spark):
    assert values(spark, ["1", "2", "3", "4", "5", None], lambda: risk.risk_score(F.col("v"))) == [1.0, 0.75, 0.5, 0.25, 0.0, 0.0]
    assert values(spark, ["CRITICAL", "high", "info", None], lambda: risk.priority(F.col("v"))) == ["critical", "high", "low", "low"]


def test_days(spark):
    got = values(spark, ["2026-01-31 23:59:59", "2025-12-31", None], lambda: risk.days_to_retirement(F.col("v").cast("timestamp"), AS_OF))
    assert got == [30, -1, None]


def test_normalisation(spark):
    assert values(spark, ["EastUS2", "marsnorth", None], lambda: normalize.region_name("v")) == ["East US 2", "marsnorth", None]
    given_ = ["sub-nonprod", "Dev-1", "a-test", "stg", "x", None]
    want = ["production", "development", "testing", "staging", "unknown", "unknown"]
    assert values(spark, given_, lambda: normalize.account_environment("v")) == want
    parts = lambda: F.struct(*[p.alias(n) for p, n in zip(normalize.runtime_parts("v"), "ab")])
    assert [tuple(r) for r in values(spark, ["PYTHON|3.9", "DOTNETCORE", "|7", "A|B|C"], parts)] == [
        ("python", "3.9"), ("dotnetcore", None), ("", "7"), ("a", "B")
    ]
    stamps = values(spark, [("", "2026-01-02"), ("2026-01-01", "x"), (None, "soon")], lambda: normalize.first_timestamp("a", "b"), "a string, b string")
    assert [s and s.date() for s in stamps] == [dt.date(2026, 1, 2), dt.date(2026, 1, 1), None]


def test_keys_keep_null_parts_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), (None, "a", "b"), ("a", "b", None)], "x string, y string, z string")
    assert df.select(keys.hash_key("x", "y", "z").alias("k")).distinct().count() == 3
    nk = df.select(keys.asset_key(F.lit("azure"), F.lit("S"), F.lit("T/X"), F.lit(" N "))).first()[0]
    assert nk == "azure|S|t/x|n"
    assert spark.range(1).select(keys.technology_key(F.lit("s"), F.lit(None), F.lit("1"))).first()[0] == "s|na|1"
