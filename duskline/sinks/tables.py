"""Tables as versioned parquet folders, with append, overwrite and keyed upsert.

Used where no table format with MERGE is installed. ``root/name/v=N`` is one
version; the newest one that carries Spark's ``_SUCCESS`` marker is current, so
an ``overwrite`` that dies half-way is never read. ``append``, ``put_batch``, ``upsert``
and ``upsert_slices`` write into the current version, where Spark's output committer
moves files in place at the end of the job: run such a load again if it died (all
but ``append`` give the same rows then). One writer per table at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from duskline.operators.upsert import merge_rows, one_row_per_key
from duskline.session import staged
from duskline.sources import schemas

# Tables that may hold no file yet (a partitioned table without rows) and so
# need a schema to be read with.
CONTRACTS = {"fact_deprecation_impact": schemas.FACT_IMPACT}
# Partition columns: the batch a row was loaded by, and the hash bucket of its key, whose
# name ends in the number of buckets. The latter is not part of a table's columns.
BATCH = "load_batch"
BUCKET = "bucket_of_"


def bucket_of(keys: list[str], buckets: int) -> Column:
    """The hash bucket of a key."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class TableStore:
    """``buckets`` is for keyed tables made from now on: enough that the rows of one suit a few tasks."""

    def __init__(self, spark: SparkSession, root: str, contracts: dict[str, StructType] | None = None, buckets: int = 16):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.contracts = CONTRACTS if contracts is None else contracts

    # -- locating ---------------------------------------------------------
    def _versions(self, name: str) -> list[int]:
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        found = []
        for status in fs.listStatus(folder):
            leaf = status.getPath().getName()
            marker = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if leaf.startswith("v=") and fs.exists(marker):
                found.append(int(leaf[2:]))
        return sorted(found)

    def _path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/v={version:06d}"

    def exists(self, name: str) -> bool:
        """Whether the table has a readable version."""
        try:
            return bool(self._versions(name)) and bool(self.read(name).columns)
        except AnalysisException:
            return False

    def missing(self, names: list[str]) -> list[str]:
        """Required tables that are not there."""
        return [n for n in names if not self.exists(n)]

    # -- reading ----------------------------------------------------------
    def read(self, name: str, evolving: bool = False) -> DataFrame:
        """The current version. ``evolving`` merges the schemas of all files, so
        columns added by later appends show; it costs a pass over every footer."""
        stored = self._stored(name, evolving)
        return stored.drop(*[c for c in stored.columns if c.startswith(BUCKET)])

    def _stored(self, name: str, evolving: bool = False) -> DataFrame:
        """The current version with its bucket column."""
        versions = self._versions(name)
        if not versions:
            raise LookupError(f"table {name} does not exist below {self.root}")
        reader = self.spark.read.option("mergeSchema", str(evolving).lower())
        if name in self.contracts and not evolving:
            reader = reader.schema(self.contracts[name])
        return reader.parquet(self._path(name, versions[-1]))

    def read_batches(self, name: str, after: int) -> DataFrame | None:
        """The rows of the loads numbered above ``after``, None without such a load; other files are not opened."""
        path = self._path(name, self._versions(name)[-1])
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        found = [s.getPath().getName() for s in folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(folder)]
        fresh = [n for n in found if n.startswith(f"{BATCH}=") and int(n.split("=")[1]) > after]
        if not fresh:
            return None
        return self.spark.read.option("mergeSchema", "true").option("basePath", path).parquet(*[f"{path}/{n}" for n in sorted(fresh)])

    # -- writing ----------------------------------------------------------
    def append(self, df: DataFrame, name: str) -> None:
        """Add rows; columns may be new."""
        versions = self._versions(name)
        df.write.mode("append").parquet(self._path(name, versions[-1] if versions else 1))

    def overwrite(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
        """Replace the table. The plan may read the version it replaces."""
        versions = self._versions(name)
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self._path(name, versions[-1] + 1 if versions else 1))

    def create_if_missing(self, df: DataFrame, name: str) -> bool:
        """Write ``df`` only where the table does not exist yet."""
        if self.exists(name):
            return False
        self.overwrite(df, name)
        return True

    def upsert(
        self,
        df: DataFrame,
        name: str,
        keys: list[str],
        keep: tuple[str, ...] = (),
        strict: bool = False,
        unique: bool = False,
    ) -> None:
        """Update rows with a known key, insert the others; ``keep`` columns are never updated.

        A keyed table is partitioned by a hash bucket of its key. Only the buckets that ``df``
        has keys of are read, merged and written again (Spark's dynamic partition overwrite).
        Where these are all that hold rows, the table gets a new version instead.
        Say ``unique`` where ``df`` already has one row per key.
        """
        source = df if unique else one_row_per_key(df, keys, strict=strict)
        if not self.exists(name):
            self._put_buckets(source, keys, self.buckets, self._path(name, (self._versions(name) or [0])[-1] + 1))
            return
        stored = self._stored(name)
        column = next((c for c in stored.columns if c.startswith(BUCKET)), None)
        if column is None or set(source.columns) - set(stored.columns):
            # Without buckets so far, or with columns that all rows get: the whole table, as a new version.
            merged = merge_rows(self.read(name), source, keys, keep)
            self._put_buckets(merged, keys, self.buckets, self._path(name, self._versions(name)[-1] + 1))
            return
        buckets = int(column[len(BUCKET):])
        source = staged(source, f"upsert-{name}")
        touched = self.touched_buckets(name, source, keys)
        if self.filled_buckets(name) <= touched:
            # Every row may change: a new version, for which nothing has to be staged.
            merged = merge_rows(self.read(name), source, keys, keep)
            self._put_buckets(merged, keys, buckets, self._path(name, self._versions(name)[-1] + 1))
            return
        before = self.touched_rows(name, source, keys, touched)
        # Spark cannot overwrite a folder it is reading, so the new buckets are staged first.
        merged = staged(merge_rows(before, source, keys, keep), f"buckets-{name}")
        self._put_buckets(merged, keys, buckets, self._path(name, self._versions(name)[-1]), "dynamic")

    def fold(self, df: DataFrame, name: str, keys: list[str], combine: Callable[[DataFrame], DataFrame]) -> None:
        """Keep what ``combine`` makes of a table's rows and the new ones: one row per key, with the table's columns.

        As in :meth:`upsert`, only the buckets with a key of ``df`` are read and written.
        ``combine`` may get a row again that it has combined before.
        """
        if not self.exists(name):
            self._put_buckets(combine(df), keys, self.buckets, self._path(name, (self._versions(name) or [0])[-1] + 1))
            return
        column = next(c for c in self._stored(name).columns if c.startswith(BUCKET))
        both = self.touched_rows(name, df, keys).unionByName(df, allowMissingColumns=True)
        merged = staged(combine(both), f"fold-{name}")
        self._put_buckets(merged, keys, int(column[len(BUCKET):]), self._path(name, self._versions(name)[-1]), "dynamic")

    def _bucket_column(self, name: str) -> str:
        return next(c for c in self._stored(name).columns if c.startswith(BUCKET))

    def touched_buckets(self, name: str, source: DataFrame, keys: list[str]) -> set[int]:
        """The buckets that hold a key of ``source``."""
        buckets = int(self._bucket_column(name)[len(BUCKET):])
        numbers = source.select(bucket_of(keys, buckets).alias("bucket")).distinct()
        return {r["bucket"] for r in numbers.collect()}

    def filled_buckets(self, name: str) -> set[int]:
        """The buckets that a table has files of, by its folder names."""
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self._path(name, self._versions(name)[-1]))
        names = [s.getPath().getName() for s in folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(folder)]
        return {int(n.split("=")[1]) for n in names if n.startswith(BUCKET)} - {-1}

    def touched_rows(self, name: str, source: DataFrame, keys: list[str], touched: set[int] | None = None) -> DataFrame:
        """The rows of the buckets that hold a key of ``source``; other buckets are not read.

        The list of touched buckets has one number per bucket at most, so it goes into
        the scan as a partition filter.
        """
        stored = self._stored(name)
        touched = self.touched_buckets(name, source, keys) if touched is None else touched
        column = self._bucket_column(name)
        return stored.filter(F.col(column).isin(sorted(touched))).drop(column)

    def _put_buckets(self, df: DataFrame, keys: list[str], buckets: int, path: str, how: str = "static") -> None:
        """Write whole buckets; in the ``dynamic`` way those of which ``df`` has no row stay as they are."""
        column = f"{BUCKET}{buckets}"
        dealt = df.withColumn(column, bucket_of(keys, buckets)).hint("rebalance", column)
        dealt.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", how).partitionBy(column).parquet(path)
        if how == "static":
            # A table without rows has no file: this one keeps the columns.
            df.limit(0).write.mode("overwrite").parquet(f"{path}/{column}=-1")

    def put_batch(self, df: DataFrame, name: str, batch: int) -> None:
        """Add the rows of a numbered load, or replace them where that load is repeated."""
        versions = self._versions(name)
        path = self._path(name, versions[-1] if versions else 1)
        numbered = df.withColumn(BATCH, F.lit(batch).cast("long"))
        if not self.exists(name):
            # The version's marker, which Spark leaves out when it replaces parts; and, as a
            # batch without rows leaves no file, one that keeps the columns.
            numbered.limit(0).write.mode("overwrite").partitionBy(BATCH).parquet(path)
            df.limit(0).write.mode("overwrite").parquet(f"{path}/{BATCH}=-1")
        numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)

    def upsert_slices(
        self,
        df: DataFrame,
        name: str,
        keys: list[str],
        slice_by: str,
        unique: bool = False,
        strict: bool = False,
    ) -> None:
        """Upsert that rewrites only the ``slice_by`` partitions present in ``df``.

        For facts that grow by one slice a day: the history is neither read nor
        written again. The slices of ``df`` stay a frame; a null slice is one like
        any other. Say ``unique`` where ``df`` already has one row per key. Slices
        that do not exist yet are simply added.
        """
        source = df if unique else one_row_per_key(df, keys, strict=strict)
        if not self.exists(name):
            self.overwrite(source, name, partition_by=[slice_by])
            return
        source = staged(source, f"upsert-{name}")
        path = self._path(name, self._versions(name)[-1])
        kind = source.schema[slice_by].dataType
        stored = self.read(name).withColumn(slice_by, F.col(slice_by).cast(kind))
        touched = source.select(slice_by).distinct()
        before = stored.join(touched, slice_by, "left_semi").select(*stored.columns)
        if source.filter(F.col(slice_by).isNull()).limit(1).count():
            before = before.union(stored.filter(F.col(slice_by).isNull()))
        if not before.limit(1).count():
            source.write.mode("append").partitionBy(slice_by).parquet(path)
            return
        # Spark cannot overwrite a folder it is reading, so the new slices are
        # staged first.
        merged = staged(merge_rows(before, source, keys), f"slices-{name}")
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(slice_by).parquet(path)

    def row_counts(self, names: list[str]) -> DataFrame:
        """(table_name, row_count) for each name, -1 where it cannot be read."""
        parts = []
        for name in names:
            if self.exists(name):
                parts.append(self.read(name).agg(F.count(F.lit(1)).alias("row_count")))
            else:
                parts.append(self.spark.range(1).select(F.lit(-1).cast("long").alias("row_count")))
            parts[-1] = parts[-1].select(F.lit(name).alias("table_name"), "row_count")
        result = parts[0]
        for part in parts[1:]:
            result = result.unionByName(part)
        return result
