"""Session settings and the shared working folder."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings the operators rely on. ANSI mode stays at its default (on):
# expressions that may meet bad input use the try_* functions.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A local session for tests and for ``bench.py``."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("duskline")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def working_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own; on a cluster a
    machine-local folder would be invisible to the other executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="duskline-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the working folder."""
    return f"{working_dir(spark)}/duskline/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For a result several writes start from: it is computed once, and a lost
    executor costs a re-read, not the whole lineage.
    """
    path = scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def date_lit(as_of: str | dt.date) -> Column:
    """``as_of`` as a DATE literal."""
    if isinstance(as_of, dt.datetime):
        as_of = as_of.date()
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def ts_lit(run_ts: str | dt.datetime | Column) -> Column:
    """``run_ts`` as a TIMESTAMP literal in the session zone (UTC)."""
    if isinstance(run_ts, Column):
        return run_ts
    if isinstance(run_ts, dt.datetime):
        if run_ts.tzinfo is not None:
            run_ts = run_ts.astimezone(dt.timezone.utc).replace(tzinfo=None)
        run_ts = run_ts.isoformat(sep=" ")
    return F.lit(run_ts).cast("timestamp")
