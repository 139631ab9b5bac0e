"""Registered queries: one per operator family, each over the driver tables.

Every query takes ``(spark, sf_dir)``, reads whole tables through the raw
adapters in ``eventlens.sources.testdata`` and returns a DataFrame whose
column names equal those of the matching SQL in ``eventlens.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.config import Config, CustomColumn
from eventlens.functions.keys import surrogate_key
from eventlens.operators import daily as daily_ops
from eventlens.operators import monthly as monthly_ops
from eventlens.operators import distinct, quality
from eventlens.operators.activity_state import advance, daily_from_state, state_at
from eventlens.operators.dedupe import dedupe_events, with_unique_event_id
from eventlens.operators.funnel import analyze_funnel, funnel_rates, register_funnel
from eventlens.operators.month_state import advance_months, month_state, monthly_from_state
from eventlens.operators.sessions import recent_actor_events, session_columns, sessionized_events, sessions
from eventlens.operators.spine import date_spine, spine_start, user_event_spine
from eventlens.operators.staging import missing_columns, stage_events, user_first_events
from eventlens.plans.pipeline import MODELS, Target, run_full, run_incremental
from eventlens.plans.publish import publish, publish_view, staged_view
from eventlens.session import ensure_checkpoint_dir
from eventlens.sources import testdata as td
from eventlens.sources.events import read_events_csv, union_connections
from eventlens.sources.ledger import FileSource, RawFiles
from eventlens.sources.sinks import lookback_start
from eventlens.streaming import start_dedupe, start_ingest

# Fixed run parameters of the test scenarios.
EVENTS_AS_OF = dt.date(2024, 1, 30)
ORDERS_AS_OF = dt.date(2001, 8, 1)
EVENTS_CFG = Config(source_name=td.EVENTS_SOURCE, as_of_date=EVENTS_AS_OF)
ORDERS_START = dt.date(1995, 1, 1)
ORDERS_CFG = Config(source_name=td.ORDERS_SOURCE, as_of_date=ORDERS_AS_OF, date_range_start=ORDERS_START)
FUNNEL_STEPS = ["view", "click", "purchase", "signup"]
DEV_FILTER = "name != 'error'"
LATE_FILTER = "name != 'error' or time < timestamp'2024-01-27 00:00:00'"
LONG_TIMEOUT = 360
LATE_CUT = dt.datetime(2024, 1, 25)
FRESHNESS_AT = dt.datetime(2024, 2, 2, 12, 0, 0)
RECENT_SINCE = dt.date(2024, 1, 23)
RANGE_START = dt.date(2024, 1, 10)
ORDERS_CUT = dt.date(1998, 1, 1)
EARLY_STATE_DAY, STATE_DAY = dt.date(2024, 1, 8), dt.date(2024, 1, 17)
EARLY_STATE_MONTH, STATE_MONTH = dt.date(1997, 2, 1), dt.date(1998, 7, 1)


def _events_stg(spark, sf, cfg=EVENTS_CFG):
    return stage_events(td.raw_from_events(spark, sf), cfg)


def _events_ev(spark, sf, cfg=EVENTS_CFG, columns=None):
    raw = td.raw_from_events(spark, sf)
    return dedupe_events(stage_events(raw, cfg), cfg, columns=columns, absent=missing_columns(raw))


def _orders_stg(spark, sf, cfg=ORDERS_CFG):
    return stage_events(td.raw_from_orders(spark, sf), cfg)


def _orders_ev(spark, sf, cfg=ORDERS_CFG, columns=None):
    return dedupe_events(_orders_stg(spark, sf, cfg), cfg, columns=columns)


# ---- staging ---------------------------------------------------------------

def q_stage_events(spark, sf):
    return _events_stg(spark, sf)


def q_custom_columns(spark, sf):
    cfg = EVENTS_CFG.with_(custom_columns=(
        CustomColumn("value", "event_value", "cast(value as decimal(10,2))"),
        CustomColumn("event_id"),
    ))
    return _events_stg(spark, sf, cfg).select("loader_row_id", "event_id", "event_value", "event_type", "date_day")


def q_pivot_properties(spark, sf):
    cfg = EVENTS_CFG.with_(properties_to_pivot=("k",))
    return _events_ev(spark, sf, cfg).select("unique_event_id", "event_properties", "k")


def q_union_sources(spark, sf):
    stg = stage_events(td.raw_from_events_two_sources(spark, sf), EVENTS_CFG)
    return stg.select("source_relation", "loader_row_id", "people_id", "event_type", "occurred_at", "date_day")


def q_global_filter(spark, sf):
    cfg = EVENTS_CFG.with_(event_filter="name != 'error' and distinct_id is not null")
    return _events_stg(spark, sf, cfg).select("loader_row_id", "people_id", "event_type", "date_day")


def q_date_range_filter(spark, sf):
    cfg = EVENTS_CFG.with_(date_range_start="2024-01-10")
    return _events_ev(spark, sf, cfg).select("unique_event_id", "occurred_at", "date_day")


def q_surrogate_key(spark, sf):
    stg = with_unique_event_id(_events_stg(spark, sf))
    return stg.select("loader_row_id", "unique_event_id",
                      surrogate_key("device_id", "date_day").alias("device_day_key"))


def q_dedupe_events(spark, sf):
    raw = td.raw_from_events_redelivered(spark, sf)
    return dedupe_events(stage_events(raw, EVENTS_CFG), EVENTS_CFG, absent=missing_columns(raw))


def q_union_missing_columns(spark, sf):
    """Two connections, the second without ``properties`` and with numeric ids:
    each is staged by itself, then they are united and de-duplicated."""
    raw = td.raw_from_events(spark, sf)
    a = raw.where(F.col("event_id") % 2 == 0)
    b = raw.where(F.col("event_id") % 2 == 1).drop("properties").withColumn("distinct_id", F.col("distinct_id").cast("long"))
    staged = [stage_events(df, EVENTS_CFG.with_(source_name=name)) for name, df in (("test.events_a", a), ("test.events_b", b))]
    return dedupe_events(staged[0].unionByName(staged[1]), EVENTS_CFG)


def q_map_passthrough(spark, sf):
    """A map column passes through the dedupe."""
    cfg = EVENTS_CFG.with_(custom_columns=(CustomColumn("properties", "property_map", "from_json(properties, 'map<string,string>')"),))
    ev = dedupe_events(stage_events(td.raw_from_events_redelivered(spark, sf), cfg), cfg)
    return ev.select("unique_event_id", F.col("property_map")["k"].alias("k"))


def q_user_first_event(spark, sf):
    return user_first_events(_events_stg(spark, sf))


# ---- spine and daily -------------------------------------------------------

def q_date_spine_sequence(spark, sf):
    first = user_first_events(_events_stg(spark, sf))
    return date_spine(spark, spine_start(first, EVENTS_CFG), EVENTS_CFG.spine_end)


def q_user_event_spine(spark, sf):
    return user_event_spine(user_first_events(_events_stg(spark, sf)), EVENTS_CFG)


def q_daily_user_counts(spark, sf):
    return daily_ops.daily_user_counts(_events_ev(spark, sf, columns=daily_ops.EVENT_COLUMNS))


def q_spine_left_join(spark, sf):
    return _trailing(spark, sf).select("source_relation", "date_day", "people_id", "event_type",
                                       "is_first_event_day", "number_of_events")


def _trailing(spark, sf):
    stg = _events_stg(spark, sf)
    ev = dedupe_events(stg, EVENTS_CFG, columns=daily_ops.EVENT_COLUMNS)
    return daily_ops.person_day_activity(ev, user_first_events(stg), EVENTS_CFG)


def q_trailing_28d_7d(spark, sf):
    return _trailing(spark, sf).select("source_relation", "date_day", "people_id", "event_type",
                                       "has_event_in_last_28_days", "has_event_in_last_7_days")


def q_repeat_users(spark, sf):
    return _trailing(spark, sf).select("source_relation", "date_day", "people_id", "event_type",
                                       "number_of_events", "is_repeat_user")


def q_daily_events(spark, sf):
    return daily_ops.daily_events_from_staged(_events_stg(spark, sf), EVENTS_CFG)


def q_daily_events_sweep(spark, sf):
    return daily_ops.daily_events_from_staged(_orders_stg(spark, sf), ORDERS_CFG)


def q_daily_events_two_sources(spark, sf):
    # the two-input form (stored event table + first events), as run_full uses it
    stg = stage_events(td.raw_from_events_two_sources(spark, sf), EVENTS_CFG)
    ev = dedupe_events(stg, EVENTS_CFG, columns=daily_ops.EVENT_COLUMNS)
    return daily_ops.daily_events(ev, user_first_events(stg), EVENTS_CFG)


def q_daily_events_date_range(spark, sf):
    cfg = EVENTS_CFG.with_(date_range_start=RANGE_START)
    return daily_ops.daily_events_from_staged(_events_stg(spark, sf, cfg), cfg)


def q_user_event_spine_date_range(spark, sf):
    cfg = EVENTS_CFG.with_(date_range_start=RANGE_START)
    return user_event_spine(user_first_events(_events_stg(spark, sf, cfg)), cfg)


# ---- monthly ---------------------------------------------------------------

def q_month_totals_mau(spark, sf):
    return monthly_ops.month_totals(_orders_ev(spark, sf, columns=monthly_ops.EVENT_COLUMNS))


def q_first_month_window(spark, sf):
    return monthly_ops.user_monthly_events(_orders_ev(spark, sf, columns=monthly_ops.EVENT_COLUMNS)).select(
        "source_relation", "people_id", "event_type", "date_month", "number_of_events", "first_month")


def q_previous_month_lag(spark, sf):
    return monthly_ops.user_monthly_events(_orders_ev(spark, sf, columns=monthly_ops.EVENT_COLUMNS)).select(
        "source_relation", "people_id", "event_type", "date_month", "previous_month_with_event")


def q_monthly_events(spark, sf):
    return monthly_ops.monthly_events(_orders_ev(spark, sf, columns=monthly_ops.EVENT_COLUMNS), ORDERS_CFG)


def q_churn_lag(spark, sf):
    return monthly_ops.monthly_events(_orders_ev(spark, sf, columns=monthly_ops.EVENT_COLUMNS), ORDERS_CFG).select(
        "source_relation", "date_month", "event_type", "number_of_users", "number_of_repeat_users",
        "number_of_churn_users")


def q_monthly_true_new_users(spark, sf):
    cfg = ORDERS_CFG.with_(date_range_start=ORDERS_CUT, true_new_users=True)
    stg = _orders_stg(spark, sf, cfg)
    ev = dedupe_events(stg, cfg, columns=monthly_ops.EVENT_COLUMNS)
    return monthly_ops.monthly_events(ev, cfg, user_first_events(stg))


# ---- sessions --------------------------------------------------------------

def _sessionized(spark, sf):
    return sessionized_events(_events_ev(spark, sf, columns=session_columns(EVENTS_CFG)), EVENTS_CFG)


def q_previous_event_lag(spark, sf):
    return _sessionized(spark, sf).select("unique_event_id", "user_id", "occurred_at", "previous_event_at")


def q_session_numbers(spark, sf):
    return _sessionized(spark, sf).select("unique_event_id", "is_new_session", "session_number", "session_id")


def q_session_event_counts(spark, sf):
    return _sessionized(spark, sf).select("unique_event_id", "session_id", "session_started_at",
                                          "number_of_this_event_type", "total_number_of_events")


def q_event_frequencies(spark, sf):
    cfg = EVENTS_CFG.with_(session_timeout_minutes=LONG_TIMEOUT)
    return sessions(_events_ev(spark, sf, columns=session_columns(cfg)), cfg).select(
        "session_id", "total_number_of_events", "event_frequencies")


def q_sessions(spark, sf):
    return sessions(_events_ev(spark, sf, columns=session_columns(EVENTS_CFG)), EVENTS_CFG)


def q_sessions_passthrough(spark, sf):
    cfg = EVENTS_CFG.with_(session_passthrough=("insert_id", "event_properties"),
                           session_filter="event_type != 'error'")
    return sessions(_events_ev(spark, sf, columns=session_columns(cfg)), cfg)


def q_sessions_two_sources(spark, sf):
    stg = stage_events(td.raw_from_events_two_sources(spark, sf), EVENTS_CFG)
    return sessions(dedupe_events(stg, EVENTS_CFG, columns=session_columns(EVENTS_CFG)), EVENTS_CFG)


def q_recent_users_semi_join(spark, sf):
    return recent_actor_events(_events_ev(spark, sf), RECENT_SINCE).select(
        "unique_event_id", "source_relation", "user_id", "occurred_at")


# ---- funnel ----------------------------------------------------------------

FUNNEL_COLUMNS = ["event_type", "people_id", "device_id", "date_day", "source_relation"]


def q_funnel(spark, sf):
    return analyze_funnel(_events_ev(spark, sf, columns=FUNNEL_COLUMNS), FUNNEL_STEPS)


def q_funnel_segmented(spark, sf):
    ev = dedupe_events(stage_events(td.raw_from_events_two_sources(spark, sf), EVENTS_CFG), EVENTS_CFG,
                       columns=FUNNEL_COLUMNS)
    return analyze_funnel(ev, ["VIEW", "Click", "purchase", "signup"], group_by_column="source_relation")


def q_funnel_criteria(spark, sf):
    return analyze_funnel(_events_ev(spark, sf, columns=FUNNEL_COLUMNS), FUNNEL_STEPS,
                          conversion_criteria="device_id is not null and date_day >= date '2024-01-15'")


# ---- data quality ----------------------------------------------------------

def _key_models(spark, sf):
    # one stored event table, of the columns the models read, feeds them all
    stg = _events_stg(spark, sf)
    first = user_first_events(stg)
    ev = _kept(dedupe_events(stg, EVENTS_CFG, columns=[*session_columns(EVENTS_CFG), *daily_ops.EVENT_COLUMNS]), "event")
    return [
        ("event", ev, "unique_event_id"),
        ("daily_events", daily_ops.daily_events(ev, first, EVENTS_CFG), "unique_key"),
        ("monthly_events", monthly_ops.monthly_events(
            _orders_ev(spark, sf, columns=monthly_ops.EVENT_COLUMNS), ORDERS_CFG), "unique_key"),
        ("sessions", sessions(ev, EVENTS_CFG), "session_id"),
        ("user_event_date_spine", user_event_spine(first, EVENTS_CFG), "unique_key"),
    ]


def q_unique_check(spark, sf):
    return quality.union_all([quality.unique_check(df, key, name) for name, df, key in _key_models(spark, sf)])


def q_not_null_check(spark, sf):
    return quality.union_all([quality.not_null_check(df, key, name) for name, df, key in _key_models(spark, sf)])


def q_freshness_check(spark, sf):
    stg = stage_events(td.raw_from_events_two_sources(spark, sf), EVENTS_CFG)
    return quality.freshness_check(stg, FRESHNESS_AT)


def _prod_dev(spark, sf):
    raw = td.raw_from_events(spark, sf)
    out = {}
    for label, cfg in (("prod", EVENTS_CFG), ("dev", EVENTS_CFG.with_(event_filter=DEV_FILTER))):
        stg = stage_events(raw, cfg)
        columns = {*session_columns(cfg), *daily_ops.EVENT_COLUMNS, *monthly_ops.EVENT_COLUMNS}
        ev = _kept(dedupe_events(stg, cfg, columns=sorted(columns)), f"event-{label}")
        out[label] = {
            "event": ev,
            "daily_events": daily_ops.daily_events(ev, user_first_events(stg), cfg),
            "monthly_events": monthly_ops.monthly_events(ev, cfg),
            "sessions": sessions(ev, cfg),
        }
    return out


def q_row_count_compare(spark, sf):
    v = _prod_dev(spark, sf)
    return quality.union_all([quality.compare_row_counts(v["prod"][m], v["dev"][m], m)
                              for m in ("event", "daily_events", "monthly_events", "sessions")])


def q_row_set_compare(spark, sf):
    v = _prod_dev(spark, sf)
    return quality.compare_row_sets(v["prod"]["daily_events"], v["dev"]["daily_events"])


# ---- incremental -----------------------------------------------------------

def q_lookback_incremental_events(spark, sf):
    """Rows an incremental run rewrites: the previous build saw only rows
    loaded before ``LATE_CUT``; the new run recomputes every day from its
    high-water mark minus the lookback, which picks up the late rows."""
    raw = td.raw_from_events(spark, sf)
    # dedupe keeps a row of every day, so the staged rows have the same last day
    previous = stage_events(raw.where(F.col("loaded_at") < F.lit(LATE_CUT)), EVENTS_CFG)
    hwm = previous.agg(F.max("date_day").alias("m")).first()["m"]
    hwm = min(hwm, EVENTS_CFG.as_of_date)
    start = lookback_start(hwm, days=EVENTS_CFG.lookback_days)
    stg = stage_events(raw, EVENTS_CFG)
    return dedupe_events(stg.where(F.col("date_day") >= F.lit(start)), EVENTS_CFG)


def _incremental(spark, sf, table, strategy="insert_overwrite", state_buckets=0):
    """A stored table after a full run over a first load of raw files and an
    incremental one that finds a second load beside it.

    The first load holds neither the rows after ``LATE_CUT`` nor every 50th
    event; those come with the second, however old they are."""
    raw = td.raw_from_events(spark, sf)
    late = F.col("event_id") % 50 == 7
    raw = raw.withColumn("loaded_at", F.when(late, F.greatest(F.col("loaded_at"), F.lit(LATE_CUT))).otherwise(F.col("loaded_at")))
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/incremental-{uuid.uuid4().hex}"
    seen = F.coalesce(F.col("loaded_at") < F.lit(LATE_CUT), F.lit(False))
    files = RawFiles({td.EVENTS_SOURCE: FileSource(f"{root}/raw")})
    target = Target(f"{root}/out", models=(table,) if table in MODELS else (), state_buckets=state_buckets)
    raw.where(seen).write.parquet(f"{root}/raw/first")
    run_full(spark, files, EVENTS_CFG, target)
    raw.where(~seen).write.parquet(f"{root}/raw/second")
    run_incremental(spark, files, EVENTS_CFG, target, strategy=strategy)
    return target.read(spark, table)


def q_incremental_event(spark, sf):
    return _incremental(spark, sf, "event")


def q_incremental_daily(spark, sf):
    return _incremental(spark, sf, "daily_events")


def q_incremental_monthly(spark, sf):
    return _incremental(spark, sf, "monthly_events")


def q_incremental_sessions(spark, sf):
    return _incremental(spark, sf, "sessions")


def q_incremental_delete_insert(spark, sf):
    return _incremental(spark, sf, "event", strategy="delete+insert")


def q_incremental_first_events(spark, sf):
    """First events merged through their bucketed keys."""
    return _incremental(spark, sf, "user_first_event", state_buckets=4)


def q_daily_from_masks(spark, sf):
    """The daily table after ``STATE_DAY`` from the day masks of that day and later events."""
    stg = _events_stg(spark, sf)
    ev = dedupe_events(stg, EVENTS_CFG, columns=daily_ops.EVENT_COLUMNS)
    first = user_first_events(stg)
    known = first.where(F.col("first_event_day") <= F.lit(STATE_DAY)).select("source_relation", "event_type").distinct()
    return daily_from_state(state_at(ev, STATE_DAY), ev.where(F.col("date_day") > F.lit(STATE_DAY)), first, known, STATE_DAY, EVENTS_CFG)


def q_daily_masks_advanced(spark, sf):
    """The same from masks of an earlier day, moved on."""
    stg = _events_stg(spark, sf)
    ev = dedupe_events(stg, EVENTS_CFG, columns=daily_ops.EVENT_COLUMNS)
    state = advance(state_at(ev, EARLY_STATE_DAY), ev, EARLY_STATE_DAY, STATE_DAY)
    return state.select(*daily_ops.PERSON_KEYS, F.col("mask"))


def q_monthly_from_state(spark, sf):
    """The monthly table from ``STATE_MONTH`` on, from the state of the months before
    (itself moved on from an earlier one) and later person-months."""
    pm = monthly_ops.person_months(_orders_ev(spark, sf, columns=monthly_ops.EVENT_COLUMNS))
    state = advance_months(month_state(pm, EARLY_STATE_MONTH), pm, EARLY_STATE_MONTH, STATE_MONTH)
    stored = monthly_ops.monthly_from_person_months(pm.where(F.col("date_month") < F.lit(STATE_MONTH)), ORDERS_CFG)
    return monthly_from_state(state, pm, stored, STATE_MONTH, ORDERS_CFG)


# ---- mergeable distinct counts ----------------------------------------------

def _work(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _kept(df, name):
    """``df`` stored and read back."""
    path = _work(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _built(spark, raw, cfg, *models):
    """A target with the event table and ``models`` of a raw frame."""
    target = Target(_work(spark, "built"), models=models)
    run_full(spark, raw, cfg, target)
    return target


def q_mau_sketches(spark, sf):
    """Monthly active users estimated from day sketches, beside the exact number:
    whether the estimate lies within four standard errors."""
    ev = _orders_ev(spark, sf, columns=monthly_ops.EVENT_COLUMNS)
    month = F.trunc("date_day", "month").alias("date_month")
    approx = distinct.sketched_users(_kept(distinct.day_sketches(ev), "sketches"), "source_relation", month)
    exact = monthly_ops.month_totals(ev)
    off = F.abs(F.col("approx_users") - F.col("total_monthly_active_users"))
    near = off <= F.greatest(F.lit(1.0), 4 * distinct.sketch_error() * F.col("total_monthly_active_users"))
    return exact.join(approx, ["source_relation", "date_month"]).select(
        "source_relation", "date_month", "total_monthly_active_users", near.alias("within_bound"))


def q_mau_bitmaps(spark, sf):
    """Exact monthly active users by merging day bitmaps."""
    ev = _orders_ev(spark, sf, columns=monthly_ops.EVENT_COLUMNS)
    bitmaps = _kept(distinct.day_bitmaps(ev, _kept(distinct.number_persons(ev), "numbers")), "bitmaps")
    month = F.trunc("date_day", "month").alias("date_month")
    return distinct.bitmap_users(bitmaps, "source_relation", month).withColumnRenamed("number_of_users", "total_monthly_active_users")


def q_funnel_bitmaps(spark, sf):
    """The segmented funnel with its users from stored bitmaps."""
    raw = td.raw_from_events_two_sources(spark, sf)
    target = _built(spark, raw, EVENTS_CFG, "user_bitmaps", "user_sketches")
    step = F.col("event_type").isin(FUNNEL_STEPS)
    seg = ["source_relation", "event_type"]
    users = distinct.bitmap_users(target.read(spark, "user_bitmaps").where(step), *seg)
    counts = target.read(spark, "user_sketches").where(step).groupBy(*seg).agg(F.sum("number_of_events").alias("number_of_events"))
    both = counts.join(users, seg, "left").fillna(0, ["number_of_users"])
    return funnel_rates(both, ["source_relation"])


# ---- SQL, catalog, other inputs ----------------------------------------------

def q_funnel_function(spark, sf):
    """The funnel called from SQL as a table function."""
    name = register_funnel(spark, _events_ev(spark, sf, columns=FUNNEL_COLUMNS), "eventlens_funnel")
    steps = ", ".join(f"'{s}'" for s in FUNNEL_STEPS)
    return spark.sql(f"SELECT * FROM {name}(array({steps}))").drop("segment")


def q_catalog_event(spark, sf):
    """The event table and the sessions read by their catalog names, joined in SQL."""
    target = _built(spark, td.raw_from_events(spark, sf), EVENTS_CFG, "sessions")
    publish(spark, target, "eventlens_check")
    publish_view(spark, "eventlens_check", "session_days", "SELECT session_started_on_day AS date_day, source_relation, count(*) AS number_of_sessions, "
                 "sum(total_number_of_events) AS session_events FROM eventlens_check.sessions GROUP BY ALL")
    return spark.sql("SELECT e.date_day, e.source_relation, e.number_of_events, s.number_of_sessions, s.session_events "
                     "FROM (SELECT date_day, source_relation, count(*) AS number_of_events FROM eventlens_check.event GROUP BY ALL) e "
                     "JOIN eventlens_check.session_days s ON e.date_day = s.date_day AND e.source_relation = s.source_relation")


def q_staged_view(spark, sf):
    """The staged rows through a persisted view over raw files."""
    path = _work(spark, "raw")
    td.raw_from_events(spark, sf).write.parquet(path)
    return spark.table(staged_view(spark, "eventlens_check", path, EVENTS_CFG))


def q_csv_events(spark, sf):
    """Raw events through a typed CSV export."""
    path = _work(spark, "csv")
    raw = td.raw_from_events(spark, sf).drop("event_id", "value")
    at = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    raw.write.options(header=True, quote='"', escape='"', timestampFormat=at, timestampNTZFormat=at).csv(path)
    return stage_events(read_events_csv(spark, path), EVENTS_CFG)


def q_source_case(spark, sf):
    """Connection names in their own case."""
    raw = td.raw_from_events(spark, sf)
    both = union_connections({"Test.Events_A": raw.where("event_id % 2 = 0"), "test.Events_B": raw.where("event_id % 2 = 1")}, preserve_case=True)
    stg = stage_events(both, EVENTS_CFG.with_(preserve_source_case=True))
    return stg.select("source_relation", "loader_row_id", "date_day")


def q_pivot_variant(spark, sf):
    """Twenty properties from one parse of each text."""
    names = [f"p{i}" for i in range(1, 20)]
    raw = td.raw_from_events(spark, sf)
    made = F.to_json(F.struct(*[(F.col("event_id") % (i + 1)).alias(n) for i, n in enumerate(names)], F.concat(F.lit("a b"), F.col("event_id")).alias("Text Of.It")))
    cfg = EVENTS_CFG.with_(properties_to_pivot=(*names, "Text Of.It"), pivot_method="variant")
    ev = dedupe_events(stage_events(raw.withColumn("properties", made), cfg), cfg)
    return ev.select("unique_event_id", *names, "text_of_it")


def q_partition_compare(spark, sf):
    """Two versions of the event table that differ on late days, found by checksums;
    the run's own columns are left out."""
    raw = td.raw_from_events(spark, sf)
    sides = [dedupe_events(stage_events(raw, c), c) for c in (EVENTS_CFG, EVENTS_CFG.with_(event_filter=LATE_FILTER, as_of_date="2024-02-01"))]
    return quality.compare_partitions(*sides, "date_day", exclude=["run_date", "loaded_at"]).select("unique_event_id", "date_day", "source")


def q_row_set_compare_except(spark, sf):
    """Row sets without the columns that differ from run to run."""
    raw = td.raw_from_events(spark, sf)
    sides = [dedupe_events(stage_events(raw, c), c) for c in (EVENTS_CFG, EVENTS_CFG.with_(event_filter=DEV_FILTER, as_of_date="2024-02-01"))]
    return quality.compare_row_sets(*sides, exclude=["run_date"]).select("unique_event_id", "event_type", "source")


def _landed(spark, raw, parts=3):
    """Raw rows as files of a landing folder, out of order; its path."""
    path = _work(spark, "landing")
    for i in (1, 0, *range(2, parts)):
        raw.where(F.col("event_id") % parts == i).write.parquet(f"{path}/part{i}")
    return path


def q_streaming_incremental(spark, sf):
    """Micro-batches that feed the incremental run."""
    raw, root = td.raw_from_events(spark, sf), _work(spark, "stream")
    path = _landed(spark, raw, 2)
    start_ingest(spark, f"{path}/*", raw.schema, EVENTS_CFG, f"{root}/out", f"{root}/progress").awaitTermination()
    return spark.read.parquet(f"{root}/out/daily_events")


def q_streaming_dedupe(spark, sf):
    """Repeated deliveries, de-duplicated by a stateful stream."""
    raw, root = td.raw_from_events_redelivered(spark, sf), _work(spark, "stream")
    path = _landed(spark, raw)
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 8).parquet(f"{path}/*")
    start_dedupe(spark, stream, EVENTS_CFG, f"{root}/out", f"{root}/progress", delay="60 days").awaitTermination()
    return spark.read.parquet(f"{root}/out/event")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stage_events": q_stage_events,
    "custom_columns": q_custom_columns,
    "pivot_properties": q_pivot_properties,
    "union_sources": q_union_sources,
    "global_filter": q_global_filter,
    "date_range_filter": q_date_range_filter,
    "surrogate_key": q_surrogate_key,
    "dedupe_events": q_dedupe_events,
    "union_missing_columns": q_union_missing_columns,
    "map_passthrough": q_map_passthrough,
    "user_first_event": q_user_first_event,
    "date_spine_sequence": q_date_spine_sequence,
    "user_event_spine": q_user_event_spine,
    "daily_user_counts": q_daily_user_counts,
    "spine_left_join": q_spine_left_join,
    "trailing_28d_7d": q_trailing_28d_7d,
    "repeat_users": q_repeat_users,
    "daily_events": q_daily_events,
    "daily_events_sweep": q_daily_events_sweep,
    "daily_events_two_sources": q_daily_events_two_sources,
    "daily_events_date_range": q_daily_events_date_range,
    "user_event_spine_date_range": q_user_event_spine_date_range,
    "month_totals_mau": q_month_totals_mau,
    "first_month_window": q_first_month_window,
    "previous_month_lag": q_previous_month_lag,
    "monthly_events": q_monthly_events,
    "churn_lag": q_churn_lag,
    "monthly_true_new_users": q_monthly_true_new_users,
    "previous_event_lag": q_previous_event_lag,
    "session_numbers": q_session_numbers,
    "session_event_counts": q_session_event_counts,
    "event_frequencies": q_event_frequencies,
    "sessions": q_sessions,
    "sessions_passthrough": q_sessions_passthrough,
    "sessions_two_sources": q_sessions_two_sources,
    "recent_users_semi_join": q_recent_users_semi_join,
    "funnel": q_funnel,
    "funnel_segmented": q_funnel_segmented,
    "funnel_criteria": q_funnel_criteria,
    "unique_check": q_unique_check,
    "not_null_check": q_not_null_check,
    "freshness_check": q_freshness_check,
    "row_count_compare": q_row_count_compare,
    "row_set_compare": q_row_set_compare,
    "lookback_incremental_events": q_lookback_incremental_events,
    "daily_from_masks": q_daily_from_masks,
    "daily_masks_advanced": q_daily_masks_advanced,
    "monthly_from_state": q_monthly_from_state,
    "mau_sketches": q_mau_sketches,
    "mau_bitmaps": q_mau_bitmaps,
    "funnel_bitmaps": q_funnel_bitmaps,
    "funnel_function": q_funnel_function,
    "catalog_event": q_catalog_event,
    "staged_view": q_staged_view,
    "csv_events": q_csv_events,
    "source_case": q_source_case,
    "pivot_variant": q_pivot_variant,
    "partition_compare": q_partition_compare,
    "row_set_compare_except": q_row_set_compare_except,
    "streaming_incremental": q_streaming_incremental,
    "streaming_dedupe": q_streaming_dedupe,
    "incremental_event": q_incremental_event,
    "incremental_daily": q_incremental_daily,
    "incremental_monthly": q_incremental_monthly,
    "incremental_sessions": q_incremental_sessions,
    "incremental_first_events": q_incremental_first_events,
    "incremental_delete_insert": q_incremental_delete_insert,
}
