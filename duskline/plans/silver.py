"""Conformed entities: accounts, assets, technologies, notices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskline.functions.keys import asset_key, hash_key, technology_key
from duskline.functions.normalize import account_environment, first_timestamp, region_name, tag_label
from duskline.functions.risk import days_to_retirement, severity
from duskline.functions.text import impact_scope, status_label, technology_family
from duskline.operators.dedupe import first_per_key, latest_per_key
from duskline.operators.tags import pivot_tags
from duskline.operators.technology import asset_technology
from duskline.plans.bronze import Origin
from duskline.session import ts_lit

SEEN = ["first_seen_at", "last_seen_at", "conformance_at"]


def cloud_account(raw: DataFrame, run_ts, origin: Origin = Origin()) -> DataFrame:
    """One row per subscription: its latest account type, first and last load."""
    accounts = raw.filter(F.col("subscription_id").isNotNull()).groupBy("subscription_id").agg(
        F.max_by("account_type", F.struct("collected_at", "account_type")).alias("account_type"),
        F.min("collected_at").alias("first_seen_at"),
        F.max("collected_at").alias("last_seen_at"),
    )
    return accounts.select(
        hash_key(F.lit(origin.cloud_provider), "subscription_id").alias("account_sk"),
        F.col("subscription_id").alias("account_nk"),
        F.lit(origin.cloud_provider).alias("cloud_provider"),
        "account_type",
        account_environment("subscription_id").alias("environment"),
        F.lit(origin.source_system).alias("source_system"),
        "first_seen_at",
        "last_seen_at",
        ts_lit(run_ts).alias("conformance_at"),
    )


def newest_resource(flat: DataFrame) -> DataFrame:
    """The newest snapshot row of each resource, with its first and last snapshot times.

    The newest row is found from its time, file and a hash, all narrow; its wide columns,
    JSON text among them, are fetched by joining back and are in no aggregation. A null time
    counts as oldest. Rows that are newest rows already (see :func:`runs.refresh_newest`)
    bring the times and the batch of all they stand for.
    """
    times = ("first_seen_at", "last_seen_at", "seen_batch")
    first, last = (c if c in flat.columns else "collected_at" for c in times[:2])
    spans = [F.min(F.coalesce(first, "collected_at")).alias(times[0]), F.max(F.coalesce(last, "collected_at")).alias(times[1])]
    if times[2] in flat.columns:
        spans.append(F.max(times[2]).alias(times[2]))
    rest = [c for c in flat.columns if c != "resource_id" and c not in times]
    marked = flat.withColumn("__row", F.xxhash64(*rest))
    rows = marked.select("resource_id", *rest, "__row")
    heads = marked.groupBy(F.col("resource_id").alias("__id")).agg(F.max(F.struct("collected_at", "source_path", "__row"))["__row"].alias("__newest"), *spans)
    found = rows.join(heads, F.col("resource_id").eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__newest")))
    # Only rows that repeat in full are left over.
    return first_per_key(found, ["resource_id"], [F.col("__row")]).drop("__row", "__newest", "__id")


def asset(
    newest: DataFrame, tags: DataFrame, run_ts, origin: Origin = Origin(), include_group: bool = False
) -> DataFrame:
    """One row per natural key from :func:`newest_resource`, with its tags.

    ``first_seen_at`` and ``last_seen_at`` span all snapshots of the resource, so
    an asset that vanishes stops being seen.
    """
    base = newest.join(pivot_tags(tags, newest="collected_at"), "resource_id", "left")
    provider = F.lit(origin.cloud_provider)
    group = "resource_group" if include_group else None
    rows = base.withColumn("asset_nk", asset_key(provider, "subscription_id", "resource_type", "resource_name", group))
    conformed = rows.select(
        hash_key("asset_nk").alias("asset_sk"),
        "asset_nk",
        provider.alias("cloud_provider"),
        F.col("subscription_id").alias("account_id"),
        "resource_group",
        F.col("resource_id").alias("native_resource_id"),
        F.col("resource_name").alias("asset_name"),
        F.lower("resource_type").alias("asset_type"),
        region_name("location").alias("region"),
        tag_label("environment", "env").alias("environment"),
        tag_label("criticality", "criticidad").alias("criticality"),
        tag_label("owner", "team", "squad").alias("owner_team"),
        *[F.col(c) for c in ("provisioning_state", "kind", "sku_name", "sku_tier")],
        F.lit(origin.source_system).alias("source_system"),
        "first_seen_at",
        "last_seen_at",
        ts_lit(run_ts).alias("conformance_at"),
    )
    return latest_per_key(conformed, ["asset_nk"], ["last_seen_at", "native_resource_id"])


def technology(newest: DataFrame, run_ts, origin: Origin = Origin()) -> DataFrame:
    """Technologies of the rows of :func:`newest_resource`."""
    return asset_technology(newest, origin.cloud_provider, origin.source_system, ts_lit(run_ts))


def notice_base(raw: DataFrame, as_of) -> DataFrame:
    """Newest row of each notice, with typed dates, folded status and days left."""
    newest = latest_per_key(
        raw.filter(F.col("notice_id").isNotNull()),
        ["vendor", "notice_id"],
        ["published_at", "collected_at", "source_path"],
    )
    return (
        newest.withColumn("published_at", first_timestamp("published_at"))
        .withColumn("retirement_at", first_timestamp("retirement_at", "retire_date"))
        .withColumn("status", status_label("status"))
        .withColumn("days_to_retirement", days_to_retirement("retirement_at", as_of))
    )


def deprecation_event(base: DataFrame, run_ts, origin: Origin = Origin()) -> DataFrame:
    """One event per notice: family, scope and severity derived."""
    stamp = ts_lit(run_ts)
    return base.select(
        hash_key("vendor", "notice_id").alias("deprecation_sk"),
        "vendor",
        "notice_id",
        F.col("title").alias("notice_title"),
        technology_family("affected_service", "affected_runtime", "title").alias("technology_family"),
        "affected_service",
        "affected_feature",
        "affected_runtime",
        "affected_version",
        "published_at",
        "retirement_at",
        severity(F.col("status"), F.col("days_to_retirement")).alias("severity"),
        impact_scope("affected_service", "affected_feature", "affected_runtime", "affected_version").alias("impact_scope"),
        "status",
        F.lit(origin.source_system).alias("source_system"),
        *[stamp.alias(c) for c in SEEN],
    )


def source_notice(base: DataFrame, run_ts) -> DataFrame:
    """One row per notice with where it came from."""
    stamp = ts_lit(run_ts)
    return base.select(
        hash_key("vendor", "notice_id").alias("notice_sk"),
        "vendor",
        "notice_id",
        F.col("title").alias("notice_title"),
        F.lit(None).cast("string").alias("notice_url"),
        "source_system",
        "source_path",
        "published_at",
        "retirement_at",
        "status",
        *[stamp.alias(c) for c in SEEN],
    )


def impacted_technology(events: DataFrame, run_ts) -> DataFrame:
    """The technology each event names, with its key."""
    stamp = ts_lit(run_ts)
    keyed = events.withColumn("technology_nk", technology_key("affected_service", "affected_runtime", "affected_version"))
    return keyed.select(
        hash_key("technology_nk").alias("technology_sk"),
        "technology_nk",
        "technology_family",
        "affected_service",
        "affected_feature",
        "affected_runtime",
        "affected_version",
        "deprecation_sk",
        "published_at",
        "retirement_at",
        "status",
        *[stamp.alias(c) for c in SEEN],
    )
