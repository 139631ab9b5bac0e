"""The event table as a stateful stream (L4, streaming form).

Raw rows stream in, in any order; each duplicate group is a streaming aggregation
whose state is the winner so far.  A watermark on the event day bounds the
state: a day is forgotten once it lies more than ``delay`` before the latest one
seen, and rows later than that are dropped.

In update mode a micro-batch brings the groups whose winner it saw anew, and the
batch upserts them: rows of the touched days that have the same
``unique_event_id`` are replaced, by rewriting the files that hold them.  Winners
that an earlier batch gave alike are only looked for in the table.  A replayed batch
gives the same table, and the checkpoint location (on shared storage) holds the state
and the progress.  Executors keep the state in RocksDB, a winner in one packed struct:
it outgrows their memory long before it outgrows their disks.

A checkpoint fixes the layout of its state: one made before the winners were packed
(without the ``PACKED`` marker) goes on with whole rows, and where its state is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlens.config import Config
from eventlens.operators.dedupe import DEDUPE_KEYS, ORDER_SQL, date_range_filtered, event_table, keep_first, packed, with_unique_event_id
from eventlens.operators.staging import stage_events
from eventlens.plans.pipeline import TABLES, Target
from eventlens.schema import conformed_names
from eventlens.sources.sinks import _jvm_path, delete_insert, staged_beside, upsert_files, write_full

#: Catalogued columns that most events have; the others (of devices, browsers, places) are often all null.
OFTEN = {"loaded_at", "loader_row_id", "device_id", "mp_processing_time_ms", "event_type_original_casing", "event_properties", "occurred_at"}
#: Flag of a batch's rows.
CHANGED = "_changed"
#: Marker file of a checkpoint whose state holds packed winners.
PACKED = "packed_winners"


def keeps_packed(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a checkpoint's state holds packed winners; a new one is marked so."""
    root = checkpoint.rstrip("/")
    fs, marker = _jvm_path(spark, f"{root}/{PACKED}")
    if not fs.exists(_jvm_path(spark, f"{root}/offsets")[1]):
        fs.mkdirs(marker.getParent())
        fs.create(marker, True).close()
    return fs.exists(marker)


def winners(stream: DataFrame, cfg: Config, delay: str, pack: bool = True) -> DataFrame:
    """The current winner of each duplicate group of a raw stream, as event-table rows;
    ``CHANGED`` is false where an earlier batch gave the same row."""
    stg = date_range_filtered(stage_events(stream, cfg), cfg)
    columns = stg.columns
    # the day as an instant (its start in UTC, whatever the session's zone) carries the watermark
    rows = with_unique_event_id(stg).withColumn("day_at", F.expr("timestamp_seconds(unix_date(date_day) * 86400L)")).drop("date_day")
    keys = [*(k for k in DEDUPE_KEYS if k != "date_day"), "day_at"]
    made_by = int(hashlib.md5(repr((cfg.as_of_date, cfg.properties_to_pivot, cfg.pivot_method)).encode()).hexdigest()[:15], 16)
    # the batch that brought a row, and the settings that it was stored with
    small = pack and packed(rows, keys, ORDER_SQL, sparse=set(conformed_names()) - OFTEN, made=["unique_event_id"], tags=["current_timestamp()", f"{made_by}L"])
    if not small:
        first = keep_first(rows.withWatermark("day_at", delay), keys, ORDER_SQL).drop("unique_event_id").selectExpr("*", f"true AS {CHANGED}")
    else:
        rows, taken = small
        first = rows.withWatermark("day_at", delay).groupBy(*keys).agg(F.min("_w").alias("_w"))
        first = first.selectExpr(*keys, *taken, f"_w._t0 = current_timestamp() OR _w._t1 <> {made_by}L AS {CHANGED}")
    first = first.selectExpr("*", "date_from_unix_date(CAST(unix_seconds(day_at) div 86400 AS INT)) AS date_day")
    return event_table(with_unique_event_id(first), cfg, [*[f"`{c}`" for c in columns], CHANGED])


STATE = "spark.sql.streaming.stateStore."
STATE_ON_DISK = {
    f"{STATE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STATE}rocksdb.boundedMemoryUsage": "true",
    f"{STATE}rocksdb.trackTotalNumberOfRows": "false",
    f"{STATE}rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started here keep their state in RocksDB, in bounded memory, where the
    session names no other store (a checkpoint goes on with its own)."""
    unset = {k: v for k, v in STATE_ON_DISK.items() if spark.conf.get(f"{STATE}providerClass", None) is None and spark.conf.get(k, None) is None}
    for k, v in unset.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in unset:
            spark.conf.unset(k)


def start_dedupe(spark: SparkSession, stream: DataFrame, cfg: Config, target: str | Target, checkpoint: str, delay: str = "7 days",
                 available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Keep ``event/`` of a target up to date from a raw stream.

    ``available_now`` takes what is there and stops (a scheduled job), otherwise a
    batch is taken every ``processing_time``."""
    target = Target.of(target)
    part, cluster = TABLES["event"]

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        path = target.path("event")
        # a batch's own session has no adaptive shuffles: its rows are stored as they lie, a file
        # for each partition of the state, and dealt to their days from there
        with staged_beside(spark, batch, path, fmt=target.fmt) as (fresh, _):
            if not target.has(spark, "event"):
                write_full(fresh.drop(CHANGED), path, part, cluster, fmt=target.fmt)
            elif target.fmt == "delta":  # its log says which files count
                delete_insert(spark, fresh.drop(CHANGED), path, "unique_event_id", part, cluster, fmt=target.fmt)
            else:
                upsert_files(spark, fresh, path, "unique_event_id", part, cluster, fmt=target.fmt, changed=CHANGED)

    rows = winners(stream, cfg, delay, keeps_packed(spark, checkpoint))
    writer = rows.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "5 minutes")
    with state_on_disk(spark):  # a stream keeps the settings it starts with
        return writer.start()
