"""Inactivity sessions.

Reference semantics: per actor ``user_id = coalesce(device_id, people_id)``,
connection and calendar day (sessions never cross midnight, N14), events are
ordered by time; an event starts a new session when it is the first of the
day or when the minutes since the previous event, counted as minute
*boundaries* crossed (N1), are strictly more than the timeout.  The session
row takes people_id, device_id and pass-through columns from its first
event; ties on time are broken by ``unique_event_id`` (N4).

Plan.  Because gaps are measured between truncated minutes, an event that is
not the first of its minute can never start a session: everything is
decided per (actor, day, minute).  So events are first aggregated (map-side
combined) to (actor, day, minute, type) rows; the session windows run over
those, at most 1,440 times the types of an actor and day, whatever the data
volume, so a hot actor (say every anonymous event of a day) cannot overload a
task, and its days are dealt to different tasks.  Frequencies and totals are
sums over the same rows; no per-event window and no join.  Exchanges: (actor,
day, minute, type) after map-side combining, then (actor, day) for the window,
which every later aggregate reuses.

``sessionized_events`` gives the per-event view (previous event time,
is_new_session, session number and counts, W8-W12) for inspection.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlens.config import Config
from eventlens.functions.keys import surrogate_key
from eventlens.functions.timeutil import lit_date, sql_filter

# the actor first: sorts compare the first key's prefix, and few connections share it
PART = ["user_id", "date_day", "source_relation"]


def session_columns(cfg: Config, extra: list[str] = ()) -> list[str]:
    """Event-table columns sessions read (for a narrow dedupe); ``extra``
    adds columns referenced by ``session_filter``."""
    return ["source_relation", "event_type", "occurred_at", "unique_event_id", "people_id", "date_day",
            "device_id", *cfg.session_passthrough, *extra]


def session_events(ev: DataFrame, cfg: Config) -> DataFrame:
    """Events eligible for sessions (P13) with actor and minute bucket."""
    cond = sql_filter(cfg.session_filter)
    if cond is not None:
        ev = ev.where(cond)
    return ev.select(
        "source_relation", "event_type", "occurred_at", "unique_event_id", "people_id", "date_day", "device_id",
        F.coalesce("device_id", "people_id").alias("user_id"),
        *[F.col(c) for c in cfg.session_passthrough],
        F.date_trunc("minute", "occurred_at").alias("minute"),
    )


def _first_fields(cfg: Config) -> list[str]:
    return ["occurred_at", "unique_event_id", "people_id", "device_id", *cfg.session_passthrough]


def minute_type_counts(e: DataFrame, cfg: Config) -> DataFrame:
    """(actor, day, minute, type) rows: events, first event, last time."""
    first = F.struct(*[F.col(c) for c in _first_fields(cfg)])
    return (e.groupBy(*PART, "minute", "event_type")
             .agg(F.count("unique_event_id").alias("n"),
                  F.min(first).alias("first"),
                  F.max("occurred_at").alias("last_at")))


def minute_sessions(mt: DataFrame, cfg: Config) -> DataFrame:
    """(minute, type) rows with the session decision (W8, W9 at minute grain).

    Rows of one minute have no gap between them, so only the first of them
    can start a session; ``is_new_session`` is that of their minute."""
    m = mt.repartition("user_id", "date_day")
    w = Window.partitionBy(*PART).orderBy("minute", "event_type")
    prev = F.lag("minute").over(w)
    starts = F.when(prev.isNull() | (F.timestamp_diff("MINUTE", prev, F.col("minute"))
                                     > F.lit(cfg.session_timeout_minutes)), 1).otherwise(0)
    m = m.withColumn("starts", starts)
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    return m.withColumn("session_number", F.sum("starts").over(running))


def _frequencies(rendered, n_types):
    """``{type: n, ...}`` from the sorted ``type: n`` texts (NULL types render
    NULL and are skipped by ``array_join``); NULL when no type is known.
    Built-in array functions only, so it stays in whole-stage codegen."""
    return F.when(n_types > 0, F.concat(F.lit("{"), F.array_join(rendered, ", "), F.lit("}")))


def session_type_counts(m: DataFrame) -> DataFrame:
    """Events per session and type (A7) with each type's first event."""
    return (m.groupBy(*PART, "session_number", "event_type")
             .agg(F.sum("n").alias("number_of_events"), F.min("first").alias("first")))


def sessions(ev: DataFrame, cfg: Config) -> DataFrame:
    e = session_events(ev, cfg)
    m = minute_sessions(minute_type_counts(e, cfg), cfg)
    st = session_type_counts(m)
    per_type = F.struct("event_type", F.concat("event_type", F.lit(": "), F.col("number_of_events").cast("string"))
                        .alias("text"))
    # the type rows lie sorted by session and type: a window over them needs no
    # sort, where an aggregate that collects lists sorts them twice again
    w = Window.partitionBy(*PART, "session_number").orderBy("event_type")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    aggs = [
        F.min("first").over(whole).alias("first"),
        F.sum("number_of_events").over(whole).alias("total_number_of_events"),
        F.sort_array(F.collect_list(per_type).over(whole)).alias("pairs"),
        F.count("event_type").over(whole).alias("n_types"),
        F.row_number().over(w).alias("rank"),
    ]
    if cfg.event_frequency_map:
        known = F.when(F.col("event_type").isNotNull(), F.struct("event_type", "number_of_events"))
        aggs.append(F.map_from_entries(F.collect_list(known).over(whole)).alias("event_frequency_map"))
    s = st.select(*PART, "session_number", *aggs).where("rank = 1")
    return s.select(
        "source_relation",
        surrogate_key("user_id", "session_number", "date_day", "source_relation").alias("session_id"),
        F.col("first.people_id").alias("people_id"),
        F.col("first.occurred_at").alias("session_started_at"),
        F.col("date_day").alias("session_started_on_day"),
        "user_id",
        F.col("first.device_id").alias("device_id"),
        F.col("total_number_of_events").cast("long").alias("total_number_of_events"),
        _frequencies(F.col("pairs.text"), F.col("n_types")).alias("event_frequencies"),
        lit_date(cfg.as_of_date).alias("run_date"),
        *[F.col(f"first.{c}").alias(c) for c in cfg.session_passthrough],
        *(["event_frequency_map"] if cfg.event_frequency_map else []),
    )


def sessionized_events(ev: DataFrame, cfg: Config) -> DataFrame:
    """Per-event view: previous event time (W8), is_new_session, running
    session number (W9), session start (W10) and per-session / per-type
    counts (W11, W12).

    The only per-event window is within one (actor, day, minute); the rest
    are windows over (minute, type) rows, joined back on their key.
    """
    e = session_events(ev, cfg)
    m = minute_sessions(minute_type_counts(e, cfg), cfg)
    sess = Window.partitionBy(*PART, "session_number")
    earlier = (Window.partitionBy(*PART).orderBy("minute_number")
               .rangeBetween(Window.unboundedPreceding, -1))
    epoch = F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz")
    per_type = m.withColumn("minute_number", F.timestamp_diff("MINUTE", epoch, F.col("minute"))).select(
        *PART, "minute", "event_type", "session_number",
        F.max("starts").over(Window.partitionBy(*PART, "minute")).alias("is_new_session"),
        F.max("last_at").over(earlier).alias("previous_minute_last_at"),
        F.sum("n").over(sess).alias("total_number_of_events"),
        F.min("first").over(sess)["occurred_at"].alias("session_started_at"),
        F.sum("n").over(Window.partitionBy(*PART, "session_number", "event_type")).alias("number_of_this_event_type"))
    wm = Window.partitionBy(*PART, "minute").orderBy("occurred_at", "unique_event_id")
    ee = e.select("*", F.lag("occurred_at").over(wm).alias("prev_in_minute"),
                  F.row_number().over(wm).alias("rank_in_minute")).alias("e")
    keys = [*PART, "minute", "event_type"]
    joined = ee.join(per_type.alias("p"), [F.col(f"e.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys], "inner")
    return joined.select(
        *[F.col(f"e.{c}") for c in e.columns if c != "minute"],
        F.coalesce("e.prev_in_minute", "p.previous_minute_last_at").alias("previous_event_at"),
        F.when(F.col("e.rank_in_minute") == 1, F.col("p.is_new_session")).otherwise(0).alias("is_new_session"),
        F.col("p.session_number").alias("session_number"),
        F.col("p.session_started_at").alias("session_started_at"),
        F.col("e.date_day").alias("session_started_on_day"),
        surrogate_key(F.col("e.user_id"), F.col("p.session_number"), F.col("e.date_day"),
                      F.col("e.source_relation")).alias("session_id"),
        F.col("p.number_of_this_event_type").cast("long").alias("number_of_this_event_type"),
        F.col("p.total_number_of_events").cast("long").alias("total_number_of_events"),
    )


def recent_actor_events(ev: DataFrame, since) -> DataFrame:
    """Events of actors active on or after ``since`` (J5): a null-safe semi
    join on (connection, actor), which keeps NULL
    actors and the connection apart (N9)."""
    actor = F.coalesce("device_id", "people_id")
    e = ev.withColumn("user_id", actor)
    recent = (e.where(F.to_date("occurred_at") >= lit_date(since))
               .select("source_relation", "user_id").distinct())
    return e.join(recent, [e["source_relation"].eqNullSafe(recent["source_relation"]),
                           e["user_id"].eqNullSafe(recent["user_id"])], "left_semi")
