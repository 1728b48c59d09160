"""Readers for landed JSON: snapshots, notices, recommendations and feed pages.

A file holding one JSON array (``multiline=True``) is read by one task, so it is
for the sizes a collector writes. Bulk history belongs in JSON lines
(``multiline=False``), which Spark splits; ``duskline.sinks.landing`` writes
that form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duskline.sources import schemas


def with_source_path(df: DataFrame) -> DataFrame:
    """Add the file each row came from. Must follow the read directly."""
    return df.withColumn("source_path", F.col("_metadata.file_path"))


def read_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    multiline: bool = True,
    recursive: bool = True,
) -> DataFrame:
    """JSON files below ``path``; an empty array or empty folder keeps the schema."""
    reader = spark.read.schema(schema).option("multiLine", str(multiline).lower())
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.json(path)


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, source_path) of every JSON file below a root. Files are listed, not opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(path)
    return files.select("path", F.col("_metadata.file_path").alias("source_path"))


def new_files(spark: SparkSession, path: str, loaded: DataFrame | None) -> DataFrame:
    """(path, source_path) of the files below a root that ``loaded`` (with ``source_path``) does not know."""
    files = landed_files(spark, path)
    if loaded is None:
        return files
    return files.join(loaded.select("source_path").distinct(), "source_path", "left_anti").select("path", "source_path")


def read_snapshots(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    """All resource snapshots below a root (or in the files listed), with lineage."""
    return with_source_path(read_json(spark, path, schemas.RESOURCE, multiline))


def read_notices(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    """All landed notices below a root (or in the files listed), with lineage."""
    return with_source_path(read_json(spark, path, schemas.NOTICE, multiline))


def read_recommendations(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Landed advisor recommendations."""
    return read_json(spark, path, schemas.RECOMMENDATION, multiline)


def read_run(
    spark: SparkSession, root: str, schema: T.StructType, multiline: bool = False, **partition: str
) -> DataFrame:
    """One run of a landing root, e.g. ``read_run(spark, root, NOTICE, ingest_date='2026-01-31')``."""
    path = "/".join([root.rstrip("/")] + [f"{key}={value}" for key, value in partition.items()])
    return read_json(spark, path, schema, multiline, recursive=False)


def read_feed_pages(
    spark: SparkSession, path: str, item_schema: T.StructType, field: str = "value", multiline: bool = True
) -> DataFrame:
    """Landed response pages as (page_no, source_path, items).

    Control characters and broken UTF-8 inside strings are tolerated. ``page_no`` is null unless
    the collector wrote it into the envelope.
    """
    envelope = T.StructType([T.StructField("page_no", T.LongType()), T.StructField(field, T.ArrayType(item_schema))])
    pages = (
        spark.read.schema(envelope)
        .option("multiLine", str(multiline).lower())
        .option("recursiveFileLookup", "true")
        .option("allowUnquotedControlChars", "true")
        # Decoded by the reader, so a broken byte becomes a replacement mark and
        # does not cost the page.
        .option("encoding", "UTF-8")
        .json(path)
    )
    return with_source_path(pages).select("page_no", "source_path", F.col(field).alias("items"))


def explode_pages(pages: DataFrame, page_no: Column | None = None) -> DataFrame:
    """One row per item with its feed position (source_path, page_no, item_no).

    Every landed page counts: a page is there because it was fetched. Pages without
    items give no rows; a page without a number keeps its items, placed by its file.
    """
    numbered = pages if page_no is None else pages.withColumn("page_no", page_no.cast("long"))
    return numbered.select("source_path", "page_no", F.posexplode("items").alias("item_no", "item")).select(
        "source_path", "page_no", "item_no", "item.*"
    )


def canonical_resource(raw: DataFrame, subscription: str | Column | None = None) -> DataFrame:
    """API resource rows under their landed names; missing id, name and type become ''."""
    return raw.select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("id", "name", "type")],
        _subscription(subscription).alias("subscription_id"),
        F.col("resourceGroup").alias("resource_group"),
        *[F.col(c) for c in ("location", "kind", "sku", "tags", "properties")],
    )


def project_recommendation(raw: DataFrame) -> DataFrame:
    """The fields used out of a nested advisor payload, as text."""
    p = "properties."
    return raw.select(
        "id",
        "type",
        "subscriptionId",
        F.col(p + "resourceMetadata.resourceId").alias("impactedResourceId"),
        F.col(p + "impactedField").alias("impactedType"),
        F.col(p + "category").alias("category"),
        F.col(p + "shortDescription.problem").alias("problem"),
        F.col(p + "shortDescription.solution").alias("solution"),
        F.col(p + "lastUpdated").alias("lastUpdated"),
        F.col(p + "recommendationTypeId").alias("recommendationTypeId"),
    )


def canonical_recommendation(projected: DataFrame, subscription: str | Column | None = None) -> DataFrame:
    """Projected advisor rows under their landed names."""
    return projected.select(
        F.coalesce("id", F.lit("")).alias("id"),
        _subscription(subscription).alias("subscription_id"),
        F.col("impactedResourceId").alias("impacted_resource_id"),
        F.col("impactedType").alias("impacted_type"),
        "category",
        "problem",
        "solution",
        F.col("lastUpdated").alias("last_updated"),
        F.col("recommendationTypeId").alias("recommendation_type_id"),
    )


def _subscription(fallback: str | Column | None) -> Column:
    fallback = F.lit(fallback) if not isinstance(fallback, Column) else fallback
    return F.coalesce(F.nullif(F.col("subscriptionId"), F.lit("")), fallback)
