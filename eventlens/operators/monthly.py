"""Monthly activity per connection x event type x month.

*new* = the month is the person's first month for the type; *repeat* = the
previous active month is exactly one month back; *return* = more than one
month back; *churn* = previous row's users minus this month's repeat users
(NULL -> 0; compares with the previous *existing* row, N10); MAU counts
distinct persons over all types.  NULL persons add events, never users (N5).

Plan: a single chain with no fan-out (so the events are scanned and
de-duplicated once): one partial aggregation to person x type x month; a
window per person and month over types flags the person's first type (MAU
share); a window per person-type gives first and previous month (rows
bounded by the number of months, so a hot person is cheap); one aggregation
to type x month; windows per month (MAU = sum of shares) and per type over
months (churn).  Every window partition is bounded by types or months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlens.config import Config
from eventlens.functions.keys import concat_key
from eventlens.functions.timeutil import lit_date, month_diff

KEYS = ["source_relation", "people_id", "event_type"]
# event-table columns the monthly metrics read (for a narrow dedupe)
EVENT_COLUMNS = ["source_relation", "people_id", "event_type", "occurred_at"]


def with_month(ev: DataFrame) -> DataFrame:
    return ev.withColumn("date_month", F.trunc("occurred_at", "month"))


def month_totals(ev: DataFrame) -> DataFrame:
    """Distinct active persons per connection and month, over all types (A4)."""
    return (with_month(ev).groupBy("source_relation", "date_month")
            .agg(F.count_distinct("people_id").alias("total_monthly_active_users")))


def person_months(ev: DataFrame) -> DataFrame:
    """Events per connection, person, type and month (A5)."""
    # unique_event_id is a hash, never NULL: count rows (no key column read)
    return (with_month(ev).groupBy("source_relation", "people_id", "event_type", "date_month")
            .agg(F.count(F.lit(1)).alias("number_of_events")))


def user_monthly_events(ev: DataFrame, first: DataFrame | None = None, sub: DataFrame | None = None) -> DataFrame:
    """Person x type x month counts with first month and previous active month
    (W5, W6).  With ``first`` (all-time first events) the first month is the
    true first month instead of the first month of ``ev`` (N8)."""
    sub = sub if sub is not None else person_months(ev)
    w = Window.partitionBy(*KEYS)
    out = sub.select(
        "*",
        F.min("date_month").over(w).alias("first_month"),
        F.lag("date_month").over(w.orderBy("date_month")).alias("previous_month_with_event"),
    )
    if first is not None:
        fm = first.select(*KEYS, F.trunc("first_event_day", "month").alias("true_first_month"))
        out = (out.join(fm, [out[k].eqNullSafe(fm[k]) for k in KEYS], "left")
                  .select(*[out[c] for c in out.columns if c != "first_month"],
                          F.coalesce(fm["true_first_month"], out["first_month"]).alias("first_month")))
    return out


def monthly_metrics(ume: DataFrame) -> DataFrame:
    """Per connection, month and type counts (A6); input has one row per
    person, type and month, so ``count_if`` equals the distinct count.
    ``mau_part`` counts persons whose first type in the month is this type;
    its sum over the month's types is the month's active users."""
    has_person = F.col("people_id").isNotNull()
    gap = month_diff("previous_month_with_event", "date_month")
    prev = F.col("previous_month_with_event").isNotNull()
    return ume.groupBy("source_relation", "date_month", "event_type").agg(
        F.count_if(has_person & F.col("is_first_type_in_month")).alias("mau_part"),
        F.count_if(has_person).alias("number_of_users"),
        F.count_if(has_person & (F.col("first_month") == F.col("date_month"))).alias("number_of_new_users"),
        F.count_if(has_person & prev & (gap == 1)).alias("number_of_repeat_users"),
        F.count_if(has_person & prev & (gap > 1)).alias("number_of_return_users"),
        F.sum("number_of_events").cast("long").alias("number_of_events"),
    )


def monthly_events(ev: DataFrame, cfg: Config, first: DataFrame | None = None) -> DataFrame:
    return monthly_from_person_months(person_months(ev), cfg, first)


def monthly_from_person_months(sub: DataFrame, cfg: Config, first: DataFrame | None = None) -> DataFrame:
    """Monthly metrics from person x type x month counts (``person_months``),
    e.g. a stored table that incremental runs update month by month."""
    # one chain, no second branch over the events (a fan-out would scan and
    # de-duplicate twice): flag each person's first type of the month (window
    # over the person's types of one month, bounded by the number of types),
    # count the flags per type, and sum them over the month's types
    # one exchange by person serves both person windows below (their
    # partitioning is a superset of it); rows per person are bounded by
    # types x months, so a hot person stays small
    sub = sub.repartition("people_id")
    pm = Window.partitionBy("source_relation", "date_month", "people_id").orderBy("event_type")
    sub = sub.withColumn("is_first_type_in_month", F.row_number().over(pm) == 1)
    ume = user_monthly_events(None, first if cfg.true_new_users else None, sub=sub)
    metrics = monthly_metrics(ume)
    month = Window.partitionBy("source_relation", "date_month")
    return with_churn(metrics.withColumn("total_monthly_active_users", F.sum("mau_part").over(month)), cfg)


def with_churn(joined: DataFrame, cfg: Config) -> DataFrame:
    """The monthly table's columns; churn compares with the type's row before."""
    w = Window.partitionBy("source_relation", "event_type").orderBy("date_month")
    prev_users = F.lag("number_of_users").over(w)
    if cfg.churn_mode == "previous_month":
        # an idle previous month has no row: its users are 0
        prev_users = F.when(month_diff(F.lag("date_month").over(w), F.col("date_month")) == 1, prev_users)\
                      .otherwise(F.lit(0).cast("long"))
    return joined.select(
        "source_relation", "date_month", "event_type", "total_monthly_active_users",
        "number_of_users", "number_of_new_users", "number_of_repeat_users", "number_of_return_users",
        "number_of_events",
        F.coalesce(prev_users - F.col("number_of_repeat_users"), F.lit(0)).alias("number_of_churn_users"),
        concat_key("date_month", "event_type", "source_relation").alias("unique_key"),
        lit_date(cfg.as_of_date).alias("run_date"),
    )
