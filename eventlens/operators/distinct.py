"""Distinct persons from stored parts that merge (A4, A10).

Counts of distinct persons do not add up over days, types or segments.  Two kinds
of part do, so that a new range or segment is a union of stored rows and never a
scan of events:

* **sketches** (approximate, opt-in): one HyperLogLog sketch per connection, day
  and type, of fixed size whatever the number of persons; relative standard error
  ``sketch_error``.
* **bitmaps** (exact): persons get numbers once, and each connection, day and
  type holds a bitmap in buckets of 32,768 numbers.  Numbers are dense inside
  each task that gave them, so few buckets are thin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_KEYS = ["source_relation", "date_day", "event_type"]
#: log2 of a sketch's registers.
LG_K = 12
#: Numbers given in different tasks and runs start at multiples of this.
TASK_STEP = 1 << 33


def sketch_error(lg_k: int = LG_K) -> float:
    return 1.04 / 2 ** (lg_k / 2)


def day_sketches(ev: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """``PART_KEYS, users`` (a sketch), ``number_of_events``.  A group without known persons has an empty sketch."""
    return ev.groupBy(*PART_KEYS).agg(F.hll_sketch_agg("people_id", lg_k).alias("users"), F.count(F.lit(1)).alias("number_of_events"))


def sketched_users(sketches: DataFrame, *by: Column | str) -> DataFrame:
    """Estimated distinct persons per ``by``, from any rows of ``day_sketches``."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("approx_users"))


def number_persons(ev: DataFrame, numbers: DataFrame | None = None) -> DataFrame:
    """``people_id, person_no`` of the persons of ``ev`` that ``numbers`` lacks.

    The numbers hold for one computation only: store the rows before using them."""
    persons = ev.where(F.col("people_id").isNotNull()).select("people_id").distinct()
    base = 0
    if numbers is not None:
        persons = persons.join(numbers, "people_id", "left_anti")
        last = numbers.agg(F.max("person_no")).first()[0]
        base = 0 if last is None else (last // TASK_STEP + 1) * TASK_STEP
    return persons.select("people_id", (F.monotonically_increasing_id() + base).alias("person_no"))


def day_bitmaps(ev: DataFrame, numbers: DataFrame) -> DataFrame:
    """``PART_KEYS, bucket, persons`` (a bitmap)."""
    seen = ev.where(F.col("people_id").isNotNull()).select(*PART_KEYS, "people_id").distinct()
    no = F.col("person_no")
    return (seen.join(numbers, "people_id")
            .groupBy(*PART_KEYS, F.bitmap_bucket_number(no).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(no)).alias("persons")))


def bitmap_users(bitmaps: DataFrame, *by: Column | str) -> DataFrame:
    """Exact distinct persons per ``by``, from any rows of ``day_bitmaps``."""
    keys = [F.col(b) if isinstance(b, str) else b for b in by]
    grouped = bitmaps.select("bucket", "persons", *keys)
    names = grouped.columns[2:]
    merged = grouped.groupBy(*names, "bucket").agg(F.bitmap_or_agg("persons").alias("persons"))
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("persons")).alias("number_of_users"))
