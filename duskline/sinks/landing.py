"""Landing rows as partitioned JSON, skipping what has already landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def land_json(df: DataFrame, root: str, by: list[str], mode: str = "append") -> None:
    """Write JSON lines below ``root``, one folder per value of ``by``."""
    df.write.mode(mode).option("ignoreNullFields", "false").partitionBy(*by).json(root)


def landed_units(spark: SparkSession, root: str, by: list[str]) -> DataFrame:
    """The partition values that already exist below ``root`` (folder names only, no file is opened)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in by])
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return spark.createDataFrame([], schema)
    pattern = jvm.org.apache.hadoop.fs.Path("/".join([root.rstrip("/")] + [f"{c}=*" for c in by]))
    found = [str(s.getPath().toString()) for s in fs.globStatus(pattern) if s.isDirectory()]
    paths = spark.createDataFrame([(p,) for p in found], "path string")
    named = {c: F.regexp_extract("path", f"{c}=([^/]*)", 1) for c in by}
    # Spark's folder name for a null.
    return paths.select(*[F.when(v != "__HIVE_DEFAULT_PARTITION__", F.try_url_decode(v)).alias(c) for c, v in named.items()])


def land_missing(df: DataFrame, root: str, by: list[str], force_refresh: bool = False) -> None:
    """Land the units that are not there yet; ``force_refresh`` rewrites the units in ``df``."""
    if force_refresh:
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("ignoreNullFields", "false")
            .partitionBy(*by)
            .json(root)
        )
        return
    done = landed_units(df.sparkSession, root, by).withColumnsRenamed({c: f"__{c}" for c in by})
    same = [F.col(c).cast("string").eqNullSafe(F.col(f"__{c}")) for c in by]
    land_json(df.join(done, same, "left_anti"), root, by)


def load_summary(log: DataFrame) -> DataFrame:
    """Units per status and rows of the finished ones, from a log of (status, rows)."""
    done_rows = F.when(F.col("status") == "done", F.col("rows").cast("long"))
    return log.groupBy("status").agg(
        F.count(F.lit(1)).alias("units"),
        F.coalesce(F.sum(done_rows), F.lit(0)).cast("long").alias("rows_done"),
    )
