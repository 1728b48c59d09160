"""Row filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskline.functions.text import mentions_retirement
from duskline.session import date_lit


def in_scope(
    units: DataFrame,
    id_col: str = "subscription_id",
    state_col: str = "state",
    ids: DataFrame | list | None = None,
    include_disabled: bool = False,
) -> DataFrame:
    """Units to collect: the listed ids, else all, else those whose state is 'enabled'."""
    if isinstance(ids, DataFrame):
        return units.join(ids.select(F.col(ids.columns[0]).alias(id_col)).distinct(), id_col, "left_semi")
    if ids:
        return units.filter(F.col(id_col).isin(list(ids)))
    if include_disabled:
        return units
    return units.filter(F.lower(F.col(state_col)) == "enabled")


def retirement_window(
    df: DataFrame,
    as_of=None,
    upcoming_only: bool = False,
    year: int | None = None,
    since: int | None = None,
    date_col: str = "retire_date",
    year_col: str = "retire_year",
) -> DataFrame:
    """Optional date filters of the notice feed, combined. Dates are ISO text, which sorts as dates do."""
    if upcoming_only:
        day = F.col(date_col)
        df = df.filter(day.isNull() | (day >= F.date_format(date_lit(as_of), "yyyy-MM-dd")))
    if year is not None:
        df = df.filter(F.col(year_col) == year)
    if since is not None:
        df = df.filter(F.col(year_col) >= since)
    return df


def retirement_recommendations(
    df: DataFrame, kind: str = "microsoft.advisor/recommendations", whole_term: bool = False
) -> DataFrame:
    """Recommendations of one type (any case) whose problem or solution speaks of retirement."""
    return df.filter((F.lower("type") == kind.lower()) & mentions_retirement("problem", "solution", whole_term=whole_term))


def any_filled(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where at least one of the columns is not null."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns]))


def isin_folded(c: Column | str, values: list[str]) -> Column:
    """Membership that ignores case."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(c).isin([v.lower() for v in values])


def sliced(df: DataFrame, **selection) -> DataFrame:
    """Report slicers: keep rows whose column is one of the chosen values; None or empty means no filter."""
    for column, values in selection.items():
        if values:
            df = df.filter(F.col(column).isin(list(values) if isinstance(values, (list, tuple, set)) else [values]))
    return df


def unprocessed(df: DataFrame, loaded: DataFrame | None, by: str = "source_path") -> DataFrame:
    """Rows from files the target does not hold yet; everything when there is no target."""
    if loaded is None:
        return df
    return df.join(loaded.select(by).distinct(), by, "left_anti")
