"""Date spine (S17, S19) and the dense user x event type x day spine (D3).

A theta join ``spine.date_day >=
first_event_day`` would be a nested-loop join.  Here every first-event row
generates its own days with ``explode(sequence(..))``: linear in the output,
no join, no shuffle.  The dense spine is still a large table (persons x
types x days); daily metrics use the sweep plan in ``daily.py`` instead.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.config import Config
from eventlens.functions.keys import surrogate_key
from eventlens.functions.timeutil import lit_date, shift_date


def spine_start(first: DataFrame, cfg: Config) -> dt.date:
    """First spine day (S19): ``date_range_start`` if given, else the earliest
    first-event day, else one month before ``as_of``.  One scalar action."""
    if cfg.date_range_start is not None:
        return cfg.date_range_start
    value = first.agg(F.min("first_event_day").alias("m")).first()["m"]
    if value is None:
        return shift_date(cfg.as_of_date, months=-1)
    return value


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day in ``[start, end]`` (S17); end is the last day."""
    return spark.range(1).select(
        F.explode(F.sequence(lit_date(start), lit_date(end))).alias("date_day"))


def days_between(start, end):
    """``sequence(start, end)`` by day, empty when ``start > end``."""
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day"))).otherwise(
        F.array().cast("array<date>"))


def user_event_spine(first: DataFrame, cfg: Config) -> DataFrame:
    """Dense spine: every (person, type, connection) from its first day (or the
    range start, if later) to the last spine day (D3)."""
    lo = F.col("first_event_day")
    if cfg.date_range_start is not None:
        lo = F.greatest(lo, lit_date(cfg.date_range_start))
    spine = first.select(
        "source_relation", "people_id", "event_type", "first_event_day",
        F.explode(days_between(lo, lit_date(cfg.spine_end))).alias("date_day"))
    return spine.select(
        "source_relation", "date_day", "people_id", "event_type",
        F.when(F.col("date_day") == F.col("first_event_day"), 1).otherwise(0).alias("is_first_event_day"),
        surrogate_key("people_id", "date_day", "event_type", "source_relation").alias("unique_key"),
    )
