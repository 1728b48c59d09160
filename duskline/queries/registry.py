"""Registry of the queries over the driver tables and of the SQL each is checked against."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from duskline.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; ``sql`` may use the named common table expressions."""

    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_ctes(sql)
        return run

    return register


def cte(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


def _uses(sql: str) -> list[str]:
    return [n for n in CTES if re.search(rf"\b{n}\b", sql)]


def with_ctes(sql: str) -> str:
    """Prefix the common table expressions a statement uses, in registration order."""
    sql = sql.strip()
    needed: set[str] = set()
    todo = _uses(sql)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += [n for n in _uses(CTES[name]) if n != name]
    if not needed:
        return sql
    parts = [f"{n} AS ({body})" for n, body in CTES.items() if n in needed]
    # A statement with its own WITH clause continues the list.
    own = re.match(r"(?is)with\s+", sql)
    rest = ", " + sql[own.end():] if own else "\n" + sql
    return "WITH " + ",\n".join(parts) + rest


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its schema is read from the footer once per path, not once per use."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)
