"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duskline.session import scratch

# The white space of every word and text rule here: space, tab, line feed,
# vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


# ASCII letters (in lower case) and digits, and all bytes of characters from U+0080 on; the rest parts terms.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)


def ascii_terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8: runs of ASCII letters, digits and other characters from U+0080 on."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


_SCOPES: list[list[str]] = []


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back; see :func:`scratch_scope`."""
    spark = df.sparkSession
    path = scratch(spark, label)
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope() -> Iterator[list[str]]:
    """Collects the paths of the intermediate tables that operators stage inside, and of no others."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield made
    finally:
        _SCOPES.pop()


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete intermediate tables. For a caller that has written the results which read them."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def numbered(df: DataFrame, label: str, name: str = "__row") -> DataFrame:
    """``df`` written to the shared folder with a row number that later reads agree on."""
    return staged(df.withColumn(name, F.monotonically_increasing_id()), label)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that a result column would clash with, in any letter case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def components(edges: DataFrame, label: str, most_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges (a long, b long)``: ``(node, component)``.

    Every node that has an edge gets the smallest node it can reach. Each round
    takes the smallest label among the neighbours and then the label of that
    label, so the rounds grow with the logarithm of the longest path. Labels are
    cut from their lineage by a table in the shared folder; only one number per
    round reaches the driver.
    """
    both = staged(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        f"{label}-links",
    )
    # First label: the smaller of the node and its smallest neighbour.
    state = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    state = staged(state.select("node", F.least("node", "low").alias("component")), f"{label}-0")
    for turn in range(1, most_rounds):
        heard = (
            both.join(state, both["b"] == state["node"])
            .groupBy("a").agg(F.min("component").alias("low"))
            .select(F.col("a").alias("node"), "low")
        )
        nearer = state.join(heard, "node").select("node", F.least("component", "low").alias("component"), F.col("component").alias("was"))
        jump = state.select(F.col("node").alias("component"), F.col("component").alias("further"))
        nxt = staged(
            nearer.join(jump, "component", "left").select(
                "node", F.least("component", F.coalesce("further", "component")).alias("component"), "was"
            ),
            f"{label}-{turn}",
        )
        changed = nxt.filter(F.col("component") != F.col("was")).limit(1).count()
        state = nxt.select("node", "component")
        if not changed:
            return state
    raise RuntimeError("components did not settle")


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def bounded_batches(spark: SparkSession, rows: int = 500) -> None:
    """Python tasks get at most this many texts at a time, so that long texts fit beside each other.

    They also look for this library where the driver found it, whatever the folder
    they start in; a cluster without that path needs the package shipped to it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])
