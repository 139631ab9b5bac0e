"""Adapters from the driver's tables to the raw event shape.

The test tables are not raw product-event exports, so each adapter is a pure
projection onto the raw column names (no rows dropped, no rows invented):

``events``  name=event_type, time=ts, distinct_id=user_id, insert_id and
            loader_row_id=event_id, mp_processing_time_ms=event_id,
            properties=props, device_id='d'||user_id for every third
            event_id (exercises the actor fallback), loaded_at=ts,
            plus the extra raw columns event_id and value.
``orders``  name=o_orderpriority, time=o_orderdate, distinct_id=o_custkey,
            insert_id and loader_row_id=o_orderkey,
            mp_processing_time_ms=o_orderkey (80 months of history).

The DuckDB oracle applies the same projection (see ``eventlens.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.sources.events import union_connections

EVENTS_SOURCE = "test.events"
ORDERS_SOURCE = "test.orders"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("name"),
        F.col("ts").alias("time"),
        F.col("user_id").cast("string").alias("distinct_id"),
        F.col("event_id").cast("string").alias("insert_id"),
        F.col("event_id").cast("string").alias("loader_row_id"),
        F.col("event_id").alias("mp_processing_time_ms"),
        F.col("props").alias("properties"),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("d"), F.col("user_id").cast("string"))).alias("device_id"),
        F.col("ts").cast("timestamp").alias("loaded_at"),
        F.col("event_id"),
        F.col("value"),
    )


def raw_from_events_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice, the copy processed later (at-least-once
    delivery); the dedupe must return exactly one row per original event."""
    raw = raw_from_events(spark, sf_dir)
    copy = (raw.withColumn("mp_processing_time_ms", F.col("mp_processing_time_ms") + F.lit(10**12))
               .withColumn("loader_row_id", F.concat(F.col("loader_row_id"), F.lit("-r"))))
    return raw.unionByName(copy)


def raw_from_events_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table split into two connections by event_id parity and
    unioned back with provenance (every row kept, S2)."""
    raw = raw_from_events(spark, sf_dir)
    return union_connections({
        "test.events_a": raw.where(F.col("event_id") % 2 == 0),
        "test.events_b": raw.where(F.col("event_id") % 2 == 1),
    })


def raw_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = _table(spark, sf_dir, "orders")
    return od.select(
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderdate").alias("time"),
        F.col("o_custkey").cast("string").alias("distinct_id"),
        F.col("o_orderkey").cast("string").alias("insert_id"),
        F.col("o_orderkey").cast("string").alias("loader_row_id"),
        F.col("o_orderkey").alias("mp_processing_time_ms"),
    )
