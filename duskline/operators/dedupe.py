"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key in the given order.

    Spark turns ``row_number() = 1`` into a per-task limit before the shuffle,
    so a key that holds a large share of the rows sends one row per task.
    """
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


def latest_per_key(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """The row with the greatest ``by`` columns, nulls counting as oldest."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in by])


def first_in_feed(df: DataFrame, keys: list[str], position: list[str]) -> DataFrame:
    """The row that came first in the feed for every key.

    A null key part groups with other nulls, as a tuple in a seen-set would.
    """
    place = F.struct(*position)
    firsts = df.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in df.columns if c not in keys]), place).alias("__row"))
    return firsts.select(*keys, "__row.*").select(*df.columns)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")
