"""All registered queries. Importing this package registers them."""

from duskline.queries import (  # noqa: F401
    aggregates,
    entities,
    filters,
    io,
    joins,
    measures,
    projections,
    reports,
    tables,
)
from duskline.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
