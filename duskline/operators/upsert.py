"""Row logic of a keyed upsert, free of any table format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row_per_key(df: DataFrame, keys: list[str], strict: bool = False) -> DataFrame:
    """One source row per key: the greatest by its remaining columns, or an error when ``strict``."""
    rest = [c for c in df.columns if c not in keys]
    if strict:
        counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.max(F.struct(*rest)).alias("__row"))
        repeated = F.raise_error(F.concat(F.lit("more than one source row for key "), F.to_json(F.struct(*keys))))
        counted = counted.filter(F.when(F.col("__n") > 1, repeated.cast("boolean")).otherwise(F.lit(True)))
        return counted.select(*keys, "__row.*").select(*df.columns)
    if not rest:
        return df.distinct()
    return df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("__row")).select(*keys, "__row.*").select(*df.columns)


def merge_rows(target: DataFrame, source: DataFrame, keys: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Target after the upsert of ``source``; both sides hold one row per key.

    A null key part equals a null. A matched row takes every source column except the keys and ``keep``; a
    source null overwrites. Columns only one side has are null on the other,
    and columns only the target has are left as they are on a match.
    """
    columns = target.columns + [c for c in source.columns if c not in target.columns]
    types = {**dict(source.dtypes), **dict(target.dtypes)}
    old = target.select(*[F.col(k).alias(f"__old_{k}") for k in keys], F.struct(*target.columns).alias("__old"))
    new = source.select(*[F.col(k).alias(f"__new_{k}") for k in keys], F.struct(*source.columns).alias("__new"))
    both = old.join(new, [F.col(f"__old_{k}").eqNullSafe(F.col(f"__new_{k}")) for k in keys], "full_outer")

    def value(name: str):
        from_old = F.col("__old")[name] if name in target.columns else F.lit(None)
        from_new = F.col("__new")[name] if name in source.columns else F.lit(None)
        if name in keys:
            return F.coalesce(from_old, from_new)
        if name not in source.columns:
            return from_old
        if name not in keep:
            return F.when(F.col("__new").isNotNull(), from_new).otherwise(from_old)
        return F.when(F.col("__old").isNotNull(), from_old).otherwise(from_new)

    return both.select(*[value(c).cast(types[c]).alias(c) for c in columns])
