"""Daily activity per connection x event type x day.

Metrics: users active today; *new* = today is the
person's all-time first day for the type; *repeat* = active today and on any
of the 27 preceding days; *return* = users - new - repeat; trailing k = persons
with an event in the k days ending today.  Persons with NULL ids never count
but their type/day rows exist (N5).  The calendar runs from the first event
day (or ``date_range_start``) to ``as_of + 6``; later events are ignored.

The plan is a sweep: only *active* person-days are materialised.  A window
over each person's active days (bounded by the calendar length, so a hot
person cannot overload a task) gives the previous and next active day; each
active day contributes +1 on its day and -1 when it leaves the trailing window
(or when the next active day takes over).  Summing these deltas per type and
day and a running sum over a small type x day calendar gives the trailing
counts.  All aggregates combine map-side.

``person_day_activity`` lays the same activity out per person and calendar day
(persons x types x days rows), for inspection of single persons.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlens.config import Config
from eventlens.functions.keys import concat_key
from eventlens.functions.timeutil import lit_date
from eventlens.operators.spine import days_between, user_event_spine

PERSON_KEYS = ["source_relation", "people_id", "event_type"]
# event-table columns the daily metrics read (for a narrow dedupe)
EVENT_COLUMNS = ["source_relation", "people_id", "event_type", "date_day"]
OUT_KEYS = ["source_relation", "date_day", "event_type"]


def daily_user_counts(ev: DataFrame) -> DataFrame:
    """Events per connection, day, person and type (A2)."""
    return (ev.groupBy("source_relation", "date_day", "people_id", "event_type")
              .agg(F.count("unique_event_id").alias("number_of_events")))


def person_day_activity(ev: DataFrame, first: DataFrame, cfg: Config) -> DataFrame:
    """Every calendar day of every known (person, type): events that day (J1),
    whether any fell into the last 28 and 7 days, and whether the person is a
    repeat user (W2-W4).

    An active day reaches forward to the next one, so each (person, type) has
    an ordered list of active days; a calendar day looks up the latest active
    day at or before it, which alone decides all flags.
    """
    days = user_event_spine(first, cfg).select("source_relation", "date_day", "people_id", "event_type", "is_first_event_day")
    counts = daily_user_counts(ev).where(F.col("people_id").isNotNull() & F.col("event_type").isNotNull())
    rows = (days.withColumn("n", F.lit(0).cast("long"))
            .unionByName(counts.select(*OUT_KEYS, "people_id", F.col("number_of_events").alias("n"),
                                       F.lit(None).cast("int").alias("is_first_event_day")))
            .groupBy(*PERSON_KEYS, "date_day")
            .agg(F.max("is_first_event_day").alias("is_first_event_day"), F.sum("n").alias("number_of_events"))
            .where(F.col("is_first_event_day").isNotNull()))  # days of the calendar
    upto = Window.partitionBy(*PERSON_KEYS).orderBy("date_day")
    active_day = F.when(F.col("number_of_events") > 0, F.col("date_day"))
    latest = F.max(active_day).over(upto)
    before = F.max(active_day).over(upto.rowsBetween(Window.unboundedPreceding, -1))

    def within(day, n):
        return F.coalesce(F.datediff("date_day", day) < n, F.lit(False))

    return rows.select(
        "source_relation", "date_day", "people_id", "event_type", "is_first_event_day", "number_of_events",
        within(latest, 28).alias("has_event_in_last_28_days"),
        within(latest, 7).alias("has_event_in_last_7_days"),
        (within(before, 28) & (F.col("number_of_events") > 0)).alias("is_repeat_user"))


def finish(agg: DataFrame, cfg: Config) -> DataFrame:
    return agg.select(
        "source_relation", "date_day", "event_type",
        "number_of_events", "number_of_users", "number_of_new_users", "number_of_repeat_users",
        (F.col("number_of_users") - F.col("number_of_new_users") - F.col("number_of_repeat_users"))
        .alias("number_of_return_users"),
        "trailing_users_28d", "trailing_users_7d",
        concat_key("event_type", "date_day", "source_relation").alias("unique_key"),
        lit_date(cfg.as_of_date).alias("run_date"),
    )


def active_days(ev: DataFrame, first: DataFrame, cfg: Config) -> DataFrame:
    """Person-type-day rows: ``number_of_events`` (0 on marker-only rows) and
    whether the day is the all-time first day.

    First events join in as marker rows of the same aggregation (no join).
    Every key, NULL persons included, gets one marker at its first spine day
    (its first event day, or the spine start when earlier); it anchors the
    type's calendar, and since it is the key's smallest day it always sorts
    first in the key's window."""
    end = lit_date(cfg.spine_end)
    # the spine joins counts on equality, so NULL persons and NULL event types
    # never count (their calendar rows still exist, with zeros)
    act = (ev.where(F.col("people_id").isNotNull() & F.col("event_type").isNotNull() & (F.col("date_day") <= end))
             .select(*PERSON_KEYS, "date_day", F.lit(1).alias("n"), F.lit(0).alias("f")))
    if cfg.date_range_start is not None:
        lo = lit_date(cfg.date_range_start)
        act = act.where(F.col("date_day") >= lo)
        day = F.greatest(F.col("first_event_day"), lo)
    else:
        day = F.col("first_event_day")
    marks = (first.select(*PERSON_KEYS, day.alias("date_day"), F.lit(0).alias("n"),
                          (F.col("first_event_day") == day).cast("int").alias("f"))
                  .where(F.col("date_day") <= end))
    # unique_event_id is a hash, never NULL: counting rows equals counting it
    # and spares reading the key column from a stored event table
    return (act.unionByName(marks)
               .groupBy(*PERSON_KEYS, "date_day")
               .agg(F.sum("n").cast("long").alias("number_of_events"), F.max("f").alias("is_first_event_day")))


def daily_events(ev: DataFrame, first: DataFrame, cfg: Config) -> DataFrame:
    """Daily metrics from a de-duplicated event table and all-time first events."""
    rows = active_days(ev, first, cfg)
    w = Window.partitionBy(*PERSON_KEYS).orderBy("date_day")
    d = F.col("date_day")
    active = F.col("number_of_events") > 0
    # marker-only rows are first in their key, so a lag of the active day
    # never sees them and a lead never lands on them
    swept = rows.select(
        "source_relation", "event_type", "date_day", "number_of_events",
        F.col("is_first_event_day").cast("long").alias("is_first"),
        active.alias("active"),
        F.when(~active, d).alias("anchor_day"),
        F.lag(F.when(active, d)).over(w).alias("prev_day"),
        F.lead(d).over(w).alias("next_day"),
    )
    return _sweep_tail(swept, cfg)


def daily_events_from_staged(stg: DataFrame, cfg: Config) -> DataFrame:
    """Daily metrics straight from staged events in one scan.

    The dedupe groups are the distinct (connection, person, type, day,
    insert id) tuples, so a person-day's event count is its number of groups
    (a map-side-combined distinct, then a count).  The window over a person's
    days also gives the all-time first day (``min``, days before
    ``date_range_start`` included), so no separate first-event pass is needed.
    Equal to ``daily_events(dedupe_events(stg), user_first_events(stg))``.
    """
    end = lit_date(cfg.spine_end)
    # the bound on occurred_at (not date_day) reaches the raw scan as `time < ..`
    after_end = F.lit(cfg.spine_end + dt.timedelta(days=1)).cast("timestamp_ntz")
    groups = (stg.where(F.col("occurred_at") < after_end)
                 .select(*PERSON_KEYS, "date_day", "insert_id")
                 .distinct())
    per_day = groups.groupBy(*PERSON_KEYS, "date_day").agg(F.count(F.lit(1)).alias("groups"))
    w = Window.partitionBy(*PERSON_KEYS).orderBy("date_day")
    d = F.col("date_day")
    # counted days follow the event table's lower bound; the calendar starts at
    # the first day, clamped by a range start, as the spine does
    active = F.col("people_id").isNotNull() & F.col("event_type").isNotNull()
    if cfg.date_range_start is not None:
        active = active & (d >= lit_date(cfg.date_range_start))
    anchor = F.col("first_event_day")
    if cfg.date_range_start is not None:
        anchor = F.greatest(anchor, lit_date(cfg.date_range_start))
    # rows are ordered by day and days are unique per key: the running first
    # value is the key's first day, and the first row is the one on that day
    # (one window operator for first, lag and lead)
    rows = per_day.select("*", F.first(d).over(w).alias("first_event_day"))
    first_row = d == F.col("first_event_day")
    swept = rows.select(
        "source_relation", "event_type", "date_day",
        F.when(active, F.col("groups")).otherwise(F.lit(0)).cast("long").alias("number_of_events"),
        (d == F.col("first_event_day")).cast("long").alias("is_first"),
        active.alias("active"),
        F.when(first_row, anchor).alias("anchor_day"),
        # rows before the range start come first in a key and are inactive,
        # so the lag of the active day skips them
        F.lag(F.when(active, d)).over(w).alias("prev_day"),
        F.lead(d).over(w).alias("next_day"),
    )
    return _sweep_tail(swept, cfg)


def _sweep_tail(swept: DataFrame, cfg: Config) -> DataFrame:
    """From per person-day rows (``active`` ones carry events; ``anchor_day``
    marks a calendar start) to the daily table: +1/-1 deltas, per-type sums,
    running trailing counts, idle days filled by ``sequence``."""
    d = F.col("date_day")
    zero = F.lit(0).cast("long")
    one = F.lit(1).cast("long")
    prev_day, next_day = F.col("prev_day"), F.col("next_day")
    is_repeat = F.coalesce(F.datediff(d, prev_day) <= 27, F.lit(False)).cast("long")
    end28 = F.least(F.date_add(d, 28), F.coalesce(next_day, F.date_add(d, 28)))
    end7 = F.least(F.date_add(d, 7), F.coalesce(next_day, F.date_add(d, 7)))

    def delta(day, events, users, new, rep, d28, d7):
        return F.struct(day.alias("date_day"), events.alias("e"), users.alias("u"), new.alias("nw"),
                        rep.alias("rp"), d28.alias("d28"), d7.alias("d7"))

    on_day = [delta(d, F.col("number_of_events"), one, F.col("is_first"), is_repeat, one, one),
              delta(end28, zero, zero, zero, zero, -one, zero),
              delta(end7, zero, zero, zero, zero, zero, -one)]
    anchor = delta(F.col("anchor_day"), zero, zero, zero, zero, zero, zero)
    act, anc = F.col("active"), F.col("anchor_day").isNotNull()
    # CASE over fixed arrays (NULL explodes to no rows) keeps the projection in
    # whole-stage codegen; a lambda filter would not
    items = (F.when(act & anc, F.array(*on_day, anchor)).when(act, F.array(*on_day))
              .when(anc, F.array(anchor)))
    deltas = (swept.select("source_relation", "event_type", F.explode(items).alias("x"))
                   .select("source_relation", "event_type", "x.*"))
    per_day = (deltas.where(F.col("date_day") <= lit_date(cfg.spine_end))
               .groupBy(*OUT_KEYS)
               .agg(*[F.sum(c).alias(c) for c in ["e", "u", "nw", "rp", "d28", "d7"]]))
    cal = Window.partitionBy("source_relation", "event_type").orderBy("date_day")
    run = cal.rowsBetween(Window.unboundedPreceding, 0)
    stepped = per_day.select(
        "*", F.sum("d28").over(run).alias("t28"), F.sum("d7").over(run).alias("t7"),
        F.coalesce(F.date_sub(F.lead("date_day").over(cal), 1), lit_date(cfg.spine_end)).alias("until"))
    # each row stands for its day and the idle days up to the next row
    filled = stepped.select(
        "source_relation", "event_type", "e", "u", "nw", "rp", "t28", "t7", F.col("date_day").alias("from_day"),
        F.explode(days_between(F.col("date_day"), F.col("until"))).alias("date_day"))
    same = F.col("date_day") == F.col("from_day")
    agg = filled.select(
        *OUT_KEYS,
        F.when(same, F.col("e")).otherwise(zero).alias("number_of_events"),
        F.when(same, F.col("u")).otherwise(zero).alias("number_of_users"),
        F.when(same, F.col("nw")).otherwise(zero).alias("number_of_new_users"),
        F.when(same, F.col("rp")).otherwise(zero).alias("number_of_repeat_users"),
        F.col("t28").alias("trailing_users_28d"),
        F.col("t7").alias("trailing_users_7d"),
    )
    return finish(agg, cfg)
