"""Explicit schemas of landed files and published facts (no inference over history)."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()])


# `properties` differs from one resource type to the next and holds keys that
# differ only in case, so it stays JSON text until a path is taken out of it.
RESOURCE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("subscription_id", T.StringType()),
        T.StructField("resource_group", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("sku", _strings("name tier")),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("properties", T.StringType()),
    ]
)

NOTICE = T.StructType(
    [
        T.StructField("created", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("retire_date", T.StringType()),
        T.StructField("retire_year", T.LongType()),
    ]
)

RECOMMENDATION = _strings(
    "id subscription_id impacted_resource_id impacted_type category problem solution"
    " last_updated recommendation_type_id"
)

FEED_ITEM = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("created", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)

# Recommendation as the source API sends it, before projection.
RAW_RECOMMENDATION = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("subscriptionId", T.StringType()),
        T.StructField(
            "properties",
            T.StructType(
                [
                    T.StructField("category", T.StringType()),
                    T.StructField("resourceMetadata", _strings("resourceId")),
                    T.StructField("impactedField", T.StringType()),
                    T.StructField("shortDescription", _strings("problem solution")),
                    T.StructField("lastUpdated", T.StringType()),
                    T.StructField("recommendationTypeId", T.StringType()),
                ]
            ),
        ),
    ]
)

# Resource as the source API sends it.
RAW_RESOURCE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("resourceGroup", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("subscriptionId", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("sku", _strings("name tier")),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("properties", T.StringType()),
    ]
)

FACT_IMPACT = T.StructType(
    [
        T.StructField("date_sk", T.IntegerType()),
        T.StructField("asset_sk", T.StringType()),
        T.StructField("deprecation_sk", T.StringType()),
        T.StructField("technology_sk", T.StringType()),
        T.StructField("risk_band_sk", T.StringType()),
        T.StructField("risk_score", T.DoubleType()),
        T.StructField("is_affected", T.BooleanType()),
        T.StructField("days_to_retirement", T.IntegerType()),
        T.StructField("priority", T.StringType()),
        T.StructField("remediation_status", T.StringType()),
        T.StructField("snapshot_date", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)
