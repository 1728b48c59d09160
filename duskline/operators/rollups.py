"""Aggregations shared by the builders, KPIs and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS = F.count


def row_count(name: str = "row_count") -> Column:
    return F.count(F.lit(1)).alias(name)


def group_count(df: DataFrame, *keys: str, name: str = "row_count") -> DataFrame:
    return df.groupBy(*keys).agg(row_count(name))


def top_groups(df: DataFrame, *keys: str, n: int, name: str = "row_count") -> DataFrame:
    """The ``n`` largest groups, null keys left out; ties broken by key."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return group_count(df, *keys, name=name).orderBy(F.desc(name), *keys).limit(n)


def technology_rollup(technology: DataFrame) -> DataFrame:
    """Per resource: rows, and the distinct families and runtime names as sorted JSON arrays."""
    as_json = lambda c: F.to_json(F.array_sort(F.collect_set(c)))
    return technology.groupBy("resource_id").agg(
        F.count(F.lit(1)).alias("technology_count"),
        as_json("technology_family").alias("technology_families_json"),
        as_json("runtime_name").alias("runtime_names_json"),
    )


def join_counts(assets: DataFrame, rollup: DataFrame) -> DataFrame:
    """Assets with the rollup of their resource; assets without technology keep nulls."""
    side = rollup.withColumnRenamed("resource_id", "native_resource_id")
    return assets.join(side, "native_resource_id", "left")


def null_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Null rows of each column in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])
