"""Incremental loads as availableNow streams.

The file source remembers which files it has delivered, which replaces the
anti join against the target. A batch that is delivered again after a crash has
its old number: raw tables replace what they have of it, keyed ones absorb it, so no
watermark and no state is needed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from duskline.plans import bronze, silver
from duskline.plans.bronze import Origin
from duskline.sinks.tables import TableStore
from duskline.sources import schemas
from duskline.sources.landing import with_source_path


# Files of one batch at most, so that the first load of a long history comes in steps.
FILES_PER_BATCH = 10_000


def stream_json(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> DataFrame:
    """New JSON files below ``path`` as a stream, with lineage. A file counts as new whatever its age."""
    reader = (
        spark.readStream.schema(schema)
        .option("multiLine", str(multiline).lower())
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
        .option("maxFilesPerTrigger", str(FILES_PER_BATCH))
        .option("maxFileAge", "36500d")
    )
    return with_source_path(reader.json(path))


def upsert_stream(
    source: DataFrame,
    store: TableStore,
    name: str,
    keys: list[str],
    checkpoint: str,
    transform=lambda batch: batch,
    keep: tuple[str, ...] = (),
    unique: bool = False,
) -> StreamingQuery:
    """Upsert everything that has arrived since the last run, then stop; ``unique`` where ``transform`` gives one row per key."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        store.upsert(transform(batch), name, keys, keep, unique=unique)

    return _stream(source, apply, checkpoint)


def _stream(source: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def inventory_batch(store: TableStore, run_ts, origin: Origin = Origin(), path: str | None = None) -> Callable[[DataFrame, int], None]:
    """Writes a numbered batch of landed snapshots to the four raw tables.

    The batch is parsed once and kept while the four writes read it. Each table holds it
    under its number, so that a batch repeated after a crash between two tables changes no row.
    """

    def apply(batch: DataFrame, number: int) -> None:
        fresh = bronze.bronze_metadata(batch, run_ts, origin).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            store.put_batch(bronze.cloud_accounts(fresh, run_ts, origin, path), "brz_inventory_cloud_raw", number)
            store.put_batch(bronze.flatten_resource(fresh), "brz_azure_resource_flat", number)
            store.put_batch(bronze.resource_tags(fresh), "brz_inventory_tag_raw", number)
            store.put_batch(bronze.resource_raw(fresh), "brz_azure_resource_raw", number)
        finally:
            fresh.unpersist()

    return apply


def stream_inventory(
    store: TableStore, path: str, checkpoint: str, run_ts, origin: Origin = Origin(), multiline: bool = True
) -> StreamingQuery:
    """Landed resource snapshots into accounts, flat resources, tags and raw rows."""
    source = stream_json(store.spark, path, schemas.RESOURCE, multiline)
    return _stream(source, inventory_batch(store, run_ts, origin, path), checkpoint)


def notice_batch(store: TableStore, run_ts, origin: Origin = Origin()) -> Callable[[DataFrame, int], None]:
    """Writes a numbered batch of landed notices to their raw table."""

    def apply(batch: DataFrame, number: int) -> None:
        store.put_batch(bronze.notice_bronze(batch, run_ts, origin), "brz_deprecation_raw", number)

    return apply


def stream_raw_notices(
    store: TableStore, path: str, checkpoint: str, run_ts, origin: Origin = Origin(), multiline: bool = True
) -> StreamingQuery:
    """Landed notices into their raw table."""
    return _stream(stream_json(store.spark, path, schemas.NOTICE, multiline), notice_batch(store, run_ts, origin), checkpoint)


def stream_notices(
    store: TableStore, path: str, checkpoint: str, as_of: dt.date, run_ts, origin: Origin = Origin(), multiline: bool = True
) -> StreamingQuery:
    """Landed notices straight into the event table. A batch is reduced to the newest row of each notice, and a key is one notice."""

    def to_events(batch: DataFrame) -> DataFrame:
        raw = bronze.notice_bronze(batch, run_ts, origin)
        return silver.deprecation_event(silver.notice_base(raw, as_of), run_ts, origin)

    source = stream_json(store.spark, path, schemas.NOTICE, multiline)
    return upsert_stream(source, store, "slv_deprecation_event", ["deprecation_sk"], checkpoint, to_events, ("first_seen_at",), unique=True)
