"""Monthly metrics from state: first and last active month per person and type.

The state of month M holds one row per person and type that was active before M.
Metrics from M on need no earlier person-month: a person's previous month is
one of the range or, before its first there, the state's last month, and its
first month is the state's.  So the state's rows of the persons in the range
join the range's person-months as one marker row each, and windows run over
those alone.  Churn compares with the type's last row before M, which the
stored monthly table has.

An old month that changes moves M back: the state is then repaired by one
aggregation (a minimum and a maximum) over the person-months before it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlens.config import Config
from eventlens.functions.timeutil import lit_date
from eventlens.operators.monthly import KEYS, monthly_metrics, with_churn


def month_state(person_months: DataFrame, month: dt.date) -> DataFrame:
    """``KEYS, first_month, last_month`` over the months before ``month``."""
    return (person_months.where(F.col("date_month") < lit_date(month)).groupBy(*KEYS)
            .agg(F.min("date_month").alias("first_month"), F.max("date_month").alias("last_month")))


def advance_months(state: DataFrame, person_months: DataFrame, state_month: dt.date, month: dt.date) -> DataFrame:
    """The state of ``month``, from that of ``state_month`` and the months between."""
    between = person_months.where((F.col("date_month") >= lit_date(state_month)) & (F.col("date_month") < lit_date(month)))
    rows = state.select(*KEYS, "first_month", "last_month").unionByName(
        between.select(*KEYS, F.col("date_month").alias("first_month"), F.col("date_month").alias("last_month")))
    return rows.groupBy(*KEYS).agg(F.min("first_month").alias("first_month"), F.max("last_month").alias("last_month"))




def monthly_from_state(state: DataFrame, person_months: DataFrame, stored: DataFrame, state_month: dt.date, cfg: Config,
                       first: DataFrame | None = None) -> DataFrame:
    """The monthly table's rows from ``state_month`` on.

    ``person_months`` and ``stored`` (the monthly table) are read from and up to
    ``state_month``; ``first`` (first events) only where ``cfg.true_new_users`` asks
    for all-time first months."""
    since = lit_date(state_month)
    now = person_months.where(F.col("date_month") >= since)
    here = now.select(*[F.col(k).alias(f"_{k}") for k in KEYS]).distinct()
    met = state.join(here, [state[k].eqNullSafe(here[f"_{k}"]) for k in KEYS], "left_semi")
    rows = now.select(*KEYS, "date_month", "number_of_events", F.lit(None).cast("date").alias("before")).unionByName(
        met.select(*KEYS, F.col("last_month").alias("date_month"), F.lit(0).cast("long").alias("number_of_events"),
                   F.col("first_month").alias("before")))
    # one exchange by person serves both windows; a person has a row for each
    # type and month of the range and one marker for each type
    rows = rows.repartition("people_id")
    types = Window.partitionBy("source_relation", "date_month", "people_id").orderBy("event_type")
    w = Window.partitionBy(*KEYS)
    ume = rows.select(
        "*", (F.row_number().over(types) == 1).alias("is_first_type_in_month"),
        F.least(F.min("before").over(w), F.min("date_month").over(w)).alias("first_month"),
        F.lag("date_month").over(w.orderBy("date_month")).alias("previous_month_with_event"),
    ).where(F.col("date_month") >= since)
    if first is not None and cfg.true_new_users:
        began = first.where(F.col("first_event_day") >= since)
        began = began.select(*[F.col(k).alias(f"_{k}") for k in KEYS], F.trunc("first_event_day", "month").alias("_true"))
        ume = ume.drop("first_month").join(began, [ume[k].eqNullSafe(began[f"_{k}"]) for k in KEYS], "left")
        ume = ume.withColumnRenamed("_true", "first_month").drop(*[f"_{k}" for k in KEYS])
    metrics = monthly_metrics(ume)
    month = Window.partitionBy("source_relation", "date_month")
    metrics = metrics.withColumn("total_monthly_active_users", F.sum("mau_part").over(month))
    last = (stored.where(F.col("date_month") < since).groupBy("source_relation", "event_type")
            .agg(F.max_by("number_of_users", "date_month").alias("number_of_users"), F.max("date_month").alias("date_month")))
    both = metrics.unionByName(last, allowMissingColumns=True)
    return with_churn(both, cfg).where(F.col("date_month") >= since)
