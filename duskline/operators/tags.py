"""Resource tags: map to rows, rows to columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskline.operators.filters import isin_folded

# The tag keys that describe an asset.
ASSET_TAGS = ("env", "environment", "criticality", "criticidad", "team", "owner", "squad", "app")


def tag_map(tags: Column | str, json_text: bool = False) -> Column:
    """Tags as map<string,string>; JSON text is parsed, bad text gives null."""
    tags = F.col(tags) if isinstance(tags, str) else tags
    return F.from_json(tags, "map<string,string>") if json_text else tags


def explode_tags(df: DataFrame, tags: Column, carry: list[str | Column]) -> DataFrame:
    """One row per tag; a null or empty map gives none."""
    return df.select(*carry, F.explode(tags).alias("tag_key", "tag_value"))


def pivot_tags(
    tags: DataFrame,
    keys: tuple[str, ...] = ASSET_TAGS,
    by: str = "resource_id",
    newest: str | None = None,
) -> DataFrame:
    """One column per tag key, keys folded.

    A key may come in two spellings or from several snapshots: the newest
    snapshot wins, then the smallest value.
    """
    folded = tags.filter(isin_folded("tag_key", list(keys))).withColumn("tag_key", F.lower("tag_key"))
    value = F.min("tag_value")
    if newest is not None:
        folded = folded.groupBy(by, "tag_key", newest).agg(value.alias("tag_value"))
        value = F.max_by("tag_value", newest)
    return folded.groupBy(by).pivot("tag_key", [k.lower() for k in keys]).agg(value)
