"""Landed files as streams into the raw tables and the repository history.

The checkpoint remembers which files were read, so no cursor is needed. A batch that is delivered
again after a failure is merged by key and leaves the same rows. Batches of one table run one after
another, which is what the merge needs.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from osspulse.operators.merge import latest_in_batch
from osspulse.pipeline import RAW_PARTITION, RAW_TABLES, with_month
from osspulse.plans import dims, staging
from osspulse.sinks import Layer, ensure_layers, merge_table, snapshot_table
from osspulse.sources import PAGE, attributed, stream_endpoint

Clock = Callable[[], datetime]


def utc_now() -> datetime:
    return datetime.now(UTC)


def _start(
    stream: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if available_now else writer.start()


def start_load(
    spark: SparkSession,
    landing: str,
    endpoint: str,
    checkpoint: str,
    *,
    available_now: bool = True,
    multi_line: bool = False,
    **options: str,
) -> StreamingQuery:
    """Upsert every landed file of an endpoint into its raw table, once."""
    ensure_layers(spark)
    table = RAW_TABLES[endpoint]

    def merge(batch: DataFrame, _batch_id: int) -> None:
        session = batch.sparkSession
        rows = with_month(attributed(batch, endpoint), table)
        merge_table(
            session,
            Layer.RAW.table(endpoint),
            rows,
            table.keys,
            RAW_PARTITION,
            order_by=[table.version, "_loaded_at", PAGE],
            transient=[PAGE],
            key_fixes_partition=table.key_fixes_partition,
        )

    stream = stream_endpoint(spark, landing, endpoint, multi_line, **options)
    return _start(stream, merge, checkpoint, available_now)


def start_history(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    *,
    clock: Clock = utc_now,
    available_now: bool = True,
    **options: str,
) -> StreamingQuery:
    """Bring the repository history up to each batch of landed repository records."""
    ensure_layers(spark)

    def merge(batch: DataFrame, _batch_id: int) -> None:
        now = clock()
        landed = attributed(batch, "repositories")
        newest = latest_in_batch(landed, ["id"], ["updated_at", "_loaded_at", PAGE])
        snapshot_table(
            batch.sparkSession,
            Layer.SNAPSHOTS.table("snap_repositories"),
            staging.stg_repositories(newest),
            "repository_id",
            dims.VERSIONED_ATTRIBUTES,
            now,
        )

    stream = stream_endpoint(spark, landing, "repositories", **options)
    return _start(stream, merge, checkpoint, available_now)
