"""From feed items to the notices that are landed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskline.functions.text import is_tagged, retire_date, text_matches
from duskline.operators.dedupe import first_in_feed

POSITION = ["source_path", "page_no", "item_no"]


def normalize_notice(items: DataFrame, *carry: str) -> DataFrame:
    """created (10 characters), trimmed title, status, retire_date and retire_year of each item."""
    title = F.trim(F.coalesce("title", F.lit("")))
    day = retire_date(F.concat_ws(" ", title, F.coalesce("description", F.lit(""))))
    return items.select(
        F.substring(F.coalesce("created", F.lit("")), 1, 10).alias("created"),
        title.alias("title"),
        "status",
        F.date_format(day, "yyyy-MM-dd").alias("retire_date"),
        F.year(day).cast("long").alias("retire_year"),
        *carry,
    )


def retirement_notices(items: DataFrame, pattern: str | None = None) -> DataFrame:
    """Tagged items that match the pattern, the first of each (created, title) in feed order."""
    picked = items.filter(is_tagged("tags") & text_matches(pattern, "title", "description"))
    return first_in_feed(normalize_notice(picked, *POSITION), ["created", "title"], POSITION).drop(*POSITION)


def by_retirement(notices: DataFrame) -> DataFrame:
    """Feed order of the landed notices: earliest retirement first, undated last, then title."""
    return notices.orderBy(F.col("retire_date").asc_nulls_last(), "title")
