"""Natural keys, hash keys and date keys.

Hash keys replace random ones, so a re-run gives every row the key it had.
A null part counts as an empty one: dropping it would let two different rows
share a key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def joined(*parts: Column | str, null_as: str = "") -> Column:
    """Parts separated by '|', nulls spelled ``null_as``."""
    return F.concat_ws("|", *[F.coalesce(_col(p).cast("string"), F.lit(null_as)) for p in parts])


def hash_key(*parts: Column | str) -> Column:
    """sha-256 hex of the joined parts."""
    return F.sha2(joined(*parts), 256)


def asset_key(
    provider: Column | str,
    subscription: Column | str,
    resource_type: Column | str,
    resource_name: Column | str,
    resource_group: Column | str | None = None,
) -> Column:
    """Natural key of an asset; pass ``resource_group`` to keep same-named resources apart."""
    parts = [_col(provider), _col(subscription), F.lower(_col(resource_type)), F.lower(F.trim(_col(resource_name)))]
    if resource_group is not None:
        parts.insert(2, F.lower(_col(resource_group)))
    return joined(*parts)


def technology_key(service: Column | str, runtime: Column | str, version: Column | str) -> Column:
    """Natural key of the technology a notice names."""
    return joined(service, runtime, version, null_as="na")


def technology_sk(dimension_key: Column | str, family: Column | str, name: Column | str, version: Column | str) -> Column:
    """Key from the technology dimension, or a hash of the triple when it is not there."""
    return F.coalesce(_col(dimension_key), hash_key(family, name, version))


def date_sk(day: Column | str) -> Column:
    """yyyymmdd as an integer."""
    day = _col(day)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")
