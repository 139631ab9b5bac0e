"""Micro-batch ingestion that feeds the incremental run (L1, streaming form).

A scheduled incremental run recomputes the last ``lookback_days``.  Here Structured Streaming watches the append-only raw
folder; each micro-batch only tells *which days* received rows (a bounded
list, never the rows themselves), and the batch then runs the incremental plan
over the raw table for those days, so late rows older than the lookback are
picked up and only what they reach is rewritten.  Writes are partition
overwrites, hence idempotent: a replayed micro-batch gives the same tables,
and the checkpoint location (on shared storage) records progress.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventlens.config import Config
from eventlens.plans.pipeline import run_incremental


def touched_days(batch: DataFrame, time_col: str = "time") -> list[dt.date]:
    rows = batch.select(F.to_date(time_col).alias("d")).where("d is not null").distinct().collect()
    return sorted(r["d"] for r in rows)


def start_ingest(spark: SparkSession, raw_path: str, schema: T.StructType, cfg: Config, target_root: str,
                 checkpoint: str, fmt: str = "parquet", available_now: bool = True,
                 processing_time: str | None = None) -> StreamingQuery:
    """Start the ingestion stream; ``available_now`` processes what is there
    and stops (a scheduled job), otherwise it triggers every ``processing_time``."""
    stream = spark.readStream.schema(schema).format(fmt).load(raw_path)

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        touched = touched_days(batch)
        if not touched:
            return
        raw = spark.read.schema(schema).format(fmt).load(raw_path)
        run_incremental(spark, raw, cfg, target_root, touched=touched)

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time or "5 minutes")
    return writer.start()
