"""Volume-ordered conversion funnel.

Steps are matched case-insensitively (P16) and an optional SQL criterion is
applied (P17).  Per [segment,] step: events and distinct persons (A10), then
overall conversion = n / max n and relative conversion = n / previous n in
descending volume order (W13-W15), 1 at the top, 0 after a zero step.  Ties
in volume are broken by event type (N13); a zero denominator gives NULL
instead of an ANSI error (N12).

Plan: one aggregation (count distinct is planned as a two-level aggregate,
so a hot step is combined map-side); the windows then run over at most
(#segments x #steps) rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlens.functions.timeutil import sql_filter


def _ratio(num, den) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def analyze_funnel(ev: DataFrame, event_funnel: list[str], group_by_column: str | None = None,
                   conversion_criteria: str | Column | None = None) -> DataFrame:
    steps = [s.lower() for s in event_funnel]
    cond = F.lower("event_type").isin(steps)
    extra = sql_filter(conversion_criteria)
    if extra is not None:
        cond = cond & extra
    seg = [group_by_column] if group_by_column else []
    if group_by_column and group_by_column not in ev.columns:
        # an expression segment (e.g. "date_trunc('month', occurred_at)"), named by its text
        ev = ev.withColumn(group_by_column, F.expr(group_by_column))
    grouped = (ev.where(cond).groupBy(*seg, "event_type")
                 .agg(F.count(F.lit(1)).alias("number_of_events"),  # the hash key is never NULL
                      F.count_distinct("people_id").alias("number_of_users")))
    return funnel_rates(grouped, seg)


def funnel_rates(grouped: DataFrame, seg: list[str]) -> DataFrame:
    """Conversions from ``number_of_events`` and ``number_of_users`` per step of each segment."""
    part = Window.partitionBy(*seg) if seg else Window.partitionBy()
    n_ev, n_us = F.col("number_of_events"), F.col("number_of_users")
    prev_ev = F.lag(n_ev).over(part.orderBy(n_ev.desc(), F.col("event_type").asc()))
    prev_us = F.lag(n_us).over(part.orderBy(n_us.desc(), F.col("event_type").asc()))

    def relative(n, prev):
        return F.when(prev == 0, F.lit(0.0)).when(prev.isNull(), F.lit(1.0)).otherwise(_ratio(n, prev))

    return grouped.select(
        *seg, "event_type", "number_of_events", "number_of_users",
        _ratio(n_ev, F.max(n_ev).over(part)).alias("overall_event_pct_conversion"),
        _ratio(n_us, F.max(n_us).over(part)).alias("overall_user_pct_conversion"),
        relative(n_ev, prev_ev).alias("relative_event_pct_conversion"),
        relative(n_us, prev_us).alias("relative_user_pct_conversion"),
    ).orderBy(*seg, F.col("number_of_events").desc(), "event_type")


def register_funnel(spark: SparkSession, events: DataFrame | str, name: str = "analyze_funnel", group_by_column: str | None = None) -> str:
    """The funnel as a SQL table function of this session, so that SQL users can write

        SELECT * FROM analyze_funnel(array('view', 'click', 'purchase'))

    ``events`` is the event table: a catalog name, or a frame (registered as a
    temporary view).  The first argument names the steps; the second, optional one
    is a person's minimum of events in a step to count there (``least_events``).
    ``group_by_column`` is a column or SQL expression of the segment, fixed when
    the function is made.  Returns the function's name."""
    if not re.fullmatch(r"[A-Za-z_]\w*", name):
        raise ValueError(f"not a function name: {name!r}")
    if not isinstance(events, str):
        events.createOrReplaceTempView(f"{name}_events")
        events = f"{name}_events"
    segment = f"({group_by_column})" if group_by_column else "'all'"

    def rate(n: str) -> str:
        before = f"lag({n}) OVER (PARTITION BY segment ORDER BY {n} DESC, event_type)"
        return f"CASE WHEN {before} IS NULL THEN 1D WHEN {before} = 0 THEN 0D ELSE try_divide({n}, {before}) END"

    def overall(n: str) -> str:
        return f"try_divide(CAST({n} AS DOUBLE), max({n}) OVER (PARTITION BY segment))"

    spark.sql(f"""
    CREATE OR REPLACE TEMPORARY FUNCTION {name}(steps ARRAY<STRING>, least_events BIGINT DEFAULT 1)
    RETURNS TABLE (segment STRING, event_type STRING, number_of_events BIGINT, number_of_users BIGINT,
      overall_event_pct_conversion DOUBLE, overall_user_pct_conversion DOUBLE, relative_event_pct_conversion DOUBLE, relative_user_pct_conversion DOUBLE)
    RETURN WITH persons AS (
        SELECT CAST({segment} AS STRING) AS segment, event_type, people_id, count(*) AS n FROM {events}
        JOIN (SELECT DISTINCT lower(name) AS step FROM (SELECT explode(steps) AS name)) ON lower(event_type) = step
        GROUP BY ALL),
      counts AS (SELECT segment, event_type, sum(n) AS number_of_events, count(people_id) AS number_of_users
        FROM persons WHERE n >= least_events GROUP BY segment, event_type)
      SELECT segment, event_type, number_of_events, number_of_users, {overall("number_of_events")}, {overall("number_of_users")},
        {rate("number_of_events")}, {rate("number_of_users")} FROM counts
    """)
    return name
