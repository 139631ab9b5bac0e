"""Full-refresh and incremental runs over a target.

Layout under the target's root: ``event/`` (partitioned by date_day),
``daily_events/`` (date_day), ``monthly_events/`` (date_month), ``sessions/``
(session_started_on_day), and what incremental runs go on from:
``user_first_event/`` (first_event_day), ``person_months/`` (date_month),
``activity_state/<day>`` and ``month_state/<month>`` (the snapshots described in
``eventlens.operators.activity_state`` and ``month_state``), and ``file_ledger/``
or ``load_mark/``.  The event table is written first and read back by the other
models, so dedupe runs once and later stages start from a materialised table
(lineage cut without ``localCheckpoint``).

An incremental run finds the days that new rows belong to, and rewrites only
what those days reach, so that it gives exactly the full-refresh result (N6, N7):

* raw **files** (``RawFiles``): the ledger tells new files from those taken in,
  and only new ones are read.  The stored events of a touched day compete with
  the new rows: a stored row is its group's winner so far, and the winner of
  winners is the group's.  Files that vanished or changed have their days
  rebuilt from the other files that hold such days.
* a raw **frame** (a view, a query): ``load_mark`` keeps, per connection and day,
  the number of rows and their last load time.  Days with more rows than before
  and days of rows loaded since the connection's own last load time are touched,
  and so is the lookback window; they are recomputed from the frame.  Rows that
  vanish upstream are noticed in the window only, and a late row without a load
  time is missed where another row of its day and connection vanished.

What touched days reach:

* event, sessions: those days (sessions never cross midnight);
* first events: keys that are new or began earlier, and the partitions they move
  between;
* daily: from the earliest touched day on, from the masks of the day before;
* monthly: from the earliest touched month on, from the state of the months
  before.  A day or month before the snapshot rebuilds the snapshot, from 28 days
  of events or the stored person-months.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from contextlib import ExitStack
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.config import Config
from eventlens.functions.keys import surrogate_key
from eventlens.functions.timeutil import lit_date, shift_date
from eventlens.operators.activity_state import MAX_RANGE, advance, daily_from_state, state_at
from eventlens.operators.daily import daily_events, daily_events_from_staged
from eventlens.operators.dedupe import date_range_filtered, dedupe_events
from eventlens.operators.distinct import day_bitmaps, day_sketches, number_persons
from eventlens.operators.month_state import advance_months, month_state, monthly_from_state
from eventlens.operators.monthly import EVENT_COLUMNS as MONTHLY_COLUMNS
from eventlens.operators.monthly import monthly_events, monthly_from_person_months, person_months
from eventlens.operators.quality import not_null_check, union_all, unique_check
from eventlens.operators.sessions import session_columns, sessions
from eventlens.operators.staging import missing_columns, stage_events, user_first_events
from eventlens.plans.docs import with_descriptions
from eventlens.sources.ledger import (
    RawFiles,
    days_of_files,
    gone_files,
    ledger_entries,
    new_files,
    paths_by_connection,
    settings_of,
    stage_files,
)
from eventlens.sources.keyed import KeyedTable
from eventlens.sources.sinks import (
    NULL_PARTITION,
    delete_insert,
    high_water_mark,
    overwrite_values,
    overwrite_window,
    partition_values,
    remove,
    replace_table,
    staged_beside,
    table_exists,
    write_full,
)

# stored person x type x month counts, updated month by month (monthly input)
PERSON_MONTHS = "person_months"

# (table, partition column, clustering keys)
TABLES = {
    "event": ("date_day", ["event_type", "people_id", "source_relation", "unique_event_id"]),
    "daily_events": ("date_day", ["event_type"]),
    "monthly_events": ("date_month", ["event_type", "source_relation"]),
    "sessions": ("session_started_on_day", ["source_relation", "session_id"]),
}
PERSON_MONTH_CLUSTER = ["event_type", "source_relation", "people_id"]
MODELS = ("daily_events", "monthly_events", "sessions")
SKETCHES, BITMAPS, NUMBERS = "user_sketches", "user_bitmaps", "person_numbers"
LOAD_MARK, LEDGER = "load_mark", "file_ledger"
FIRST_EVENTS, FIRST_KEYS = "user_first_event", "first_event_keys"
FIRST_CLUSTER = ["event_type", "source_relation", "people_id"]
ACTIVITY_STATE, MONTH_STATE = "activity_state", "month_state"


@dataclass(frozen=True)
class Target:
    """Where tables are stored, in which format, and which models beside the event table.

    Models on demand: ``user_sketches`` and ``user_bitmaps`` (with ``person_numbers``),
    the mergeable parts of ``eventlens.operators.distinct``.

    With ``state_buckets`` the first events are also kept by key, in a table of so
    many buckets (``eventlens.sources.keyed``), so that merging new ones does not
    shuffle the stored ones."""

    root: str
    fmt: str = "parquet"
    models: tuple[str, ...] = MODELS
    state_buckets: int = 0

    @staticmethod
    def of(target: "str | Target") -> "Target":
        return target if isinstance(target, Target) else Target(target)

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.format(self.fmt).load(self.path(table))

    def keyed(self, spark: SparkSession) -> KeyedTable | None:
        if not self.state_buckets:
            return None
        return KeyedTable(spark, self.path(f"{FIRST_KEYS}/buckets={self.state_buckets}"), self.state_buckets, fmt=self.fmt)

    def has(self, spark: SparkSession, table: str) -> bool:
        return table_exists(spark, self.path(table), self.fmt)

    def write_full(self, df: DataFrame, table: str, partition_col: str, cluster_by: list[str]) -> None:
        write_full(with_descriptions(df, table), self.path(table), partition_col, cluster_by, fmt=self.fmt)


@dataclass
class Models:
    staged: DataFrame
    first_events: DataFrame
    events: DataFrame
    daily: DataFrame
    monthly: DataFrame
    sessions: DataFrame


def build(raw: DataFrame, cfg: Config, events: DataFrame | None = None) -> Models:
    """All models as lazy DataFrames (nothing runs until written/collected)."""
    stg = stage_events(raw, cfg)
    first = user_first_events(stg)
    if events is not None:
        ev = events
        narrow = {"daily": ev, "monthly": ev, "sessions": ev}
    else:
        # without a materialised event table every model selects its own
        # columns before the dedupe, keeping each shuffle narrow
        absent = missing_columns(raw, cfg.raw_names)
        ev = dedupe_events(stg, cfg, absent=absent)
        narrow = {
            "monthly": dedupe_events(stg, cfg, columns=MONTHLY_COLUMNS),
            # a session filter is free SQL over any column: keep the full row then
            "sessions": dedupe_events(stg, cfg, columns=None if cfg.session_filter else session_columns(cfg), absent=absent),
        }
    return Models(
        staged=stg,
        first_events=first,
        events=ev,
        daily=daily_events(narrow["daily"], first, cfg) if events is not None else daily_events_from_staged(stg, cfg),
        monthly=monthly_events(narrow["monthly"], cfg, first),
        sessions=sessions(narrow["sessions"], cfg),
    )


def since(stg: DataFrame, start: dt.date) -> DataFrame:
    """Staged rows on or after ``start``, written on ``occurred_at`` so the
    bound reaches the raw scan as ``time >= ts`` (pushed down to Parquet row
    groups / partition pruning), which ``to_date(time) >= d`` would not."""
    return stg.where(F.col("occurred_at") >= F.lit(dt.datetime.combine(start, dt.time())).cast("timestamp_ntz"))


def window_days(df: DataFrame) -> list[dt.date]:
    """Distinct ``date_day`` values of an incremental slice: bounded by the
    number of days in the window, so collecting them is safe."""
    return [r["date_day"] for r in df.select("date_day").distinct().collect() if r["date_day"] is not None]


def load_state(stg: DataFrame, now: dt.datetime) -> DataFrame:
    """Rows per connection and day, and their latest load time, capped at the
    run's time so that a future-dated row can't hide later ones."""
    seen = F.least(F.col("loaded_at").cast("timestamp"), F.lit(now).cast("timestamp"))
    return (stg.groupBy("source_relation", "date_day")
            .agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("loaded_at").isNotNull(), seen)).alias("loaded_at")))


def stored_state(spark: SparkSession, target: Target) -> DataFrame | None:
    """What earlier runs have seen; None if it was never stored in this form."""
    if not target.has(spark, LOAD_MARK):
        return None
    df = target.read(spark, LOAD_MARK)
    return df if {"source_relation", "date_day", "n", "loaded_at"} <= set(df.columns) else None


def _new_days(stg: DataFrame, now: DataFrame, before: DataFrame | None, cfg: Config) -> set[dt.date]:
    """Days of rows that earlier runs have not seen: days of a connection that
    has more rows than before (whatever their load times, also null ones), and
    those of rows loaded since the connection's own last load time.  Without a
    stored state these are all days."""
    if before is None:
        return set(window_days(now))
    was = before.select(F.col("source_relation").alias("s"), F.col("date_day").alias("d"), F.col("n").alias("n_before"))
    same = F.col("source_relation").eqNullSafe(F.col("s")) & F.col("date_day").eqNullSafe(F.col("d"))
    more = now.join(was, same, "left").where(F.col("n") > F.coalesce("n_before", F.lit(0)))
    days = set(window_days(more))
    marks = before.groupBy(F.col("source_relation").alias("s")).agg(F.max("loaded_at").alias("mark")).where("mark is not null")
    least = marks.agg(F.min("mark")).first()[0]
    if least is not None:
        # rows of the last load's own instant may have arrived after it was read
        late = stg.where(F.col("loaded_at") >= F.lit(least)).join(F.broadcast(marks), F.col("source_relation").eqNullSafe(F.col("s")))
        days.update(window_days(date_range_filtered(late.where(F.col("loaded_at") >= F.col("mark")), cfg)))
    return days


def first_events_of_range(first: DataFrame, read_from: dt.date) -> DataFrame:
    """What daily metrics from ``read_from`` on need of the first events: those
    of the range, and for each type that began before it one nameless anchor."""
    lo = lit_date(read_from)
    anchors = (first.where(F.col("first_event_day") < lo).groupBy("source_relation", "event_type")
               .agg(F.min("first_event_day").alias("first_event_day")))
    inside = first.where(F.col("first_event_day") >= lo)
    return inside.unionByName(anchors.withColumn("people_id", F.lit(None).cast("string")))


# ---- full refresh ------------------------------------------------------------

def run_full(spark: SparkSession, raw: DataFrame | RawFiles, cfg: Config, target: str | Target) -> None:
    target = Target.of(target)
    with ExitStack() as stack:
        # what the run takes in is noted before the rows are read: those that arrive meanwhile count as new next time
        if isinstance(raw, RawFiles):
            listing, _ = stack.enter_context(staged_beside(spark, raw.listing(spark), target.path(LEDGER), fmt=target.fmt))
            rows = raw.read(spark, cfg, paths_by_connection(listing))
            if rows is None:
                raise ValueError("no raw files")
            _rebuild(spark, rows, stage_events(rows, cfg), cfg, target)
            replace_table(spark, ledger_entries(listing, days_of_files(stage_files(rows, cfg)), settings_of(cfg)), target.path(LEDGER), target.fmt)
        else:
            stg = stage_events(raw, cfg)
            state, _ = stack.enter_context(staged_beside(spark, load_state(date_range_filtered(stg, cfg), dt.datetime.now()), target.path(LOAD_MARK), fmt=target.fmt))
            _rebuild(spark, raw, stg, cfg, target)
            replace_table(spark, state, target.path(LOAD_MARK), target.fmt)


def _rebuild(spark: SparkSession, raw: DataFrame, stg: DataFrame, cfg: Config, target: Target) -> None:
    _store_first(spark, user_first_events(stg), target)
    fresh = dedupe_events(stg, cfg, absent=missing_columns(raw, cfg.raw_names))
    target.write_full(fresh, "event", *TABLES["event"])
    ev = target.read(spark, "event")
    # static overwrite (write_full): the stored tables get their _SUCCESS marker,
    # which incremental runs check before merging into them
    m, hwm = build(raw, cfg, events=ev), _mark(spark, cfg, target)
    if "daily_events" in target.models:
        target.write_full(m.daily, "daily_events", *TABLES["daily_events"])
        if hwm is not None:
            day = shift_date(hwm, days=-cfg.lookback_days - 1)
            _put_snapshot(spark, state_at(ev, day), ACTIVITY_STATE, day, target)
    if "monthly_events" in target.models:
        target.write_full(person_months(ev.select(*MONTHLY_COLUMNS)), PERSON_MONTHS, "date_month", PERSON_MONTH_CLUSTER)
        pm = target.read(spark, PERSON_MONTHS)
        monthly = monthly_from_person_months(pm, cfg, target.read(spark, FIRST_EVENTS))
        target.write_full(monthly, "monthly_events", *TABLES["monthly_events"])
        if hwm is not None:
            month = shift_date(hwm, days=-cfg.lookback_days).replace(day=1)
            _put_snapshot(spark, month_state(pm, month), MONTH_STATE, month, target)
    if "sessions" in target.models:
        target.write_full(m.sessions, "sessions", *TABLES["sessions"])
    if SKETCHES in target.models:
        target.write_full(day_sketches(ev), SKETCHES, "date_day", ["event_type", "source_relation"])
    if BITMAPS in target.models:
        number_persons(ev).write.format(target.fmt).mode("overwrite").save(target.path(NUMBERS))
        target.write_full(day_bitmaps(ev, target.read(spark, NUMBERS)), BITMAPS, "date_day", ["event_type", "source_relation", "bucket"])


def _mark(spark: SparkSession, cfg: Config, target: Target) -> dt.date | None:
    return high_water_mark(spark, target.path("event"), "date_day", cfg.as_of_date, target.fmt)


# ---- snapshots -----------------------------------------------------------------

def _snapshot_day(spark: SparkSession, table: str, target: Target) -> dt.date | None:
    """Day of the stored snapshot (the last one whose write ended)."""
    days = sorted(partition_values(spark, target.path(table), "as_of"))
    done = [d for d in days if table_exists(spark, f"{target.path(table)}/as_of={d}", target.fmt)]
    return dt.date.fromisoformat(done[-1]) if done else None


def _snapshot(spark: SparkSession, table: str, day: dt.date, target: Target) -> DataFrame:
    return spark.read.format(target.fmt).load(f"{target.path(table)}/as_of={day}")


def _put_snapshot(spark: SparkSession, df: DataFrame, table: str, day: dt.date, target: Target) -> None:
    """Store a snapshot, then remove the others: a failure between leaves one to go on from.

    ``df`` may read the snapshot of another day, never that of its own."""
    df.write.format(target.fmt).mode("overwrite").save(f"{target.path(table)}/as_of={day}")
    for other in partition_values(spark, target.path(table), "as_of") - {day.isoformat()}:
        remove(spark, f"{target.path(table)}/as_of={other}")


# ---- incremental runs ------------------------------------------------------------

def run_incremental(spark: SparkSession, raw: DataFrame | RawFiles, cfg: Config, target: str | Target,
                    touched: Iterable[dt.date] = (), strategy: str = "insert_overwrite") -> dt.date | None:
    """Recompute what new rows reach; see the module's text.

    ``touched`` names further days to recompute from a raw frame (e.g. a streaming
    micro-batch's).  Returns the first rewritten day, None after a full refresh (no
    event table yet, or one staged under other settings) or where nothing is new.

    ``strategy`` is how the event table takes the recomputed rows:
    ``insert_overwrite`` replaces the touched date partitions (rows that
    vanished upstream go too); ``delete+insert`` replaces rows by
    ``unique_event_id`` and keeps the others.
    """
    if strategy not in ("insert_overwrite", "delete+insert"):
        raise ValueError(f"unknown strategy {strategy!r}")
    target = Target.of(target)
    hwm = _mark(spark, cfg, target)
    if isinstance(raw, RawFiles):
        if hwm is None or not target.has(spark, LEDGER) or not target.read(spark, LEDGER).where(F.col("settings") != settings_of(cfg)).isEmpty():
            run_full(spark, raw, cfg, target)
            return None
        return _from_files(spark, raw, cfg, target, strategy)
    if hwm is None:
        run_full(spark, raw, cfg, target)
        return None
    window = shift_date(hwm, days=-cfg.lookback_days)
    stg = stage_events(raw, cfg)
    # taken before the rows are read: those that arrive meanwhile count as new next time
    with staged_beside(spark, load_state(date_range_filtered(stg, cfg), dt.datetime.now()), target.path(LOAD_MARK), fmt=target.fmt) as (state, _):
        days = set(touched) | _new_days(stg, state, stored_state(spark, target), cfg)
        start = _from_frame(spark, raw, stg, cfg, target, days, window, strategy)
        replace_table(spark, state, target.path(LOAD_MARK), target.fmt)
    return start


def _from_frame(spark: SparkSession, raw: DataFrame, stg: DataFrame, cfg: Config, target: Target,
                days: set[dt.date], window: dt.date, strategy: str) -> dt.date:
    """Recompute ``days`` and the lookback window from a raw frame."""
    old = sorted(d for d in days if d < window)  # days before the window: a bounded list
    start = min([window, *old])
    lo = F.col("date_day") >= lit_date(window)
    in_reach = lo | F.col("date_day").isin(old) if old else lo
    recent = since(stg, start).where(in_reach)
    stored = {dt.date.fromisoformat(v) for v in partition_values(spark, target.path("event"), "date_day", target.fmt) if v != NULL_PARTITION}
    days = {*old, *(d for d in stored if d >= window), *window_days(date_range_filtered(recent, cfg))}
    fresh = dedupe_events(recent, cfg, absent=missing_columns(raw, cfg.raw_names))
    first = user_first_events(recent if target.has(spark, FIRST_EVENTS) else stg)
    _rewrite(spark, fresh, first, days, start, cfg, target, strategy)
    return start


def _from_files(spark: SparkSession, raw: RawFiles, cfg: Config, target: Target, strategy: str) -> dt.date | None:
    """Take in the files that the ledger lacks, and rebuild the days of those that are gone."""
    with ExitStack() as stack:
        listing, _ = stack.enter_context(staged_beside(spark, raw.listing(spark), target.path(LEDGER), fmt=target.fmt))
        ledger = target.read(spark, LEDGER)
        fresh_paths = paths_by_connection(new_files(listing, ledger))
        gone = {r["d"] for r in gone_files(listing, ledger).select(F.explode("days").alias("d")).distinct().collect()}
        rows = raw.read(spark, cfg, fresh_paths)
        entries = ledger.join(listing.select("connection", "file", "modified", "length"), ["connection", "file", "modified", "length"], "left_semi")
        days, start = set(gone), None
        if rows is not None:
            stg = stage_files(rows, cfg)
            # the rows' days and files: two narrow columns of the new files
            held, _ = stack.enter_context(staged_beside(spark, days_of_files(stg), target.path("new_days"), fmt=target.fmt))
            entries = entries.unionByName(ledger_entries(new_files(listing, ledger), held, settings_of(cfg)))
            found = {r["d"] for r in held.select(F.explode("days").alias("d")).distinct().collect()}
            days |= {d for d in found if d is not None and (cfg.date_range_start is None or d >= cfg.date_range_start)}
        end_moved = "daily_events" in target.models and max(partition_values(spark, target.path("daily_events"), "date_day", target.fmt), default="") != cfg.spine_end.isoformat()
        if days or rows is not None or end_moved:
            fresh, first, whole = _merged(spark, raw, rows, listing, ledger, days - gone, gone, cfg, target)
            start = min(days, default=None)
            if whole:  # minima may have lost rows, or none are stored
                _store_first(spark, first, target)
                first = None
            _rewrite(spark, fresh, first, days, start, cfg, target, strategy)
        replace_table(spark, entries, target.path(LEDGER), target.fmt)
    return start


def _merged(spark: SparkSession, raw: RawFiles, rows: DataFrame | None, listing: DataFrame, ledger: DataFrame, merge: set[dt.date], rebuild: set[dt.date],
            cfg: Config, target: Target) -> tuple[DataFrame, DataFrame | None, bool]:
    """De-duplicated events of the touched days, first events, and whether these are of all files.

    Days of ``merge``: the stored winners compete with the new rows.  Days of
    ``rebuild``: all files that hold one of them are read.  First events are those of
    the new rows; where files are gone or none are stored, of all files."""
    ev = target.read(spark, "event")
    stg = stage_events(rows, cfg) if rows is not None else None
    columns = (stg if stg is not None else stage_events(raw.read(spark, cfg), cfg)).columns
    parts = [ev.where(F.col("date_day").isin(sorted(merge))).select(*columns)]
    if stg is not None:
        parts.append(stg.where(F.col("date_day").isin(sorted(merge))))
    first = user_first_events(stg) if stg is not None else None
    if rebuild:
        days = F.array(*[lit_date(d) for d in sorted(rebuild)])
        holders = listing.join(ledger.where(~F.arrays_overlap("days", days)).select("connection", "file", "modified", "length"),
                               ["connection", "file", "modified", "length"], "left_anti")
        again = raw.read(spark, cfg, paths_by_connection(holders))
        if again is not None:
            parts.append(stage_events(again, cfg).select(*columns).where(F.col("date_day").isin(sorted(rebuild))))
    whole = bool(rebuild) or not target.has(spark, FIRST_EVENTS)
    if whole:
        everything = raw.read(spark, cfg, paths_by_connection(listing))
        first = user_first_events(stage_events(everything, cfg) if everything is not None else ev.limit(0))
    return dedupe_events(union_all(parts), cfg), first, whole


def _rewrite(spark: SparkSession, fresh: DataFrame, first: DataFrame | None, days: set[dt.date], start: dt.date | None,
             cfg: Config, target: Target, strategy: str) -> None:
    """Write the touched ``days`` of the event table and what they reach.  ``first``
    are the first events of the rows read."""
    values = {d.isoformat() for d in days}
    part, cluster = TABLES["event"]
    fresh = with_descriptions(fresh, "event")
    if days and strategy == "delete+insert":
        delete_insert(spark, fresh, target.path("event"), "unique_event_id", part, cluster, fmt=target.fmt)
    elif days:
        overwrite_values(spark, fresh, target.path("event"), part, values, cluster, fmt=target.fmt)
    ev = target.read(spark, "event")
    # a key that begins earlier than stored is no longer new on its old day
    moved = _merge_first(spark, first, target) if first is not None else None
    hwm = _mark(spark, cfg, target)
    if "daily_events" in target.models:
        _rewrite_daily(spark, ev, min([d for d in (start, moved) if d is not None], default=None), hwm, cfg, target)
    if "monthly_events" in target.models and (days or (moved is not None and cfg.true_new_users)):
        _rewrite_monthly(spark, ev, days, moved if cfg.true_new_users else None, hwm, cfg, target)
    touched = ev.where(F.col("date_day").isin(sorted(days)))
    if days and "sessions" in target.models:
        part, cluster = TABLES["sessions"]
        overwrite_values(spark, with_descriptions(sessions(touched, cfg), "sessions"), target.path("sessions"), part, values, cluster, fmt=target.fmt)
    if days and SKETCHES in target.models:
        overwrite_values(spark, day_sketches(touched), target.path(SKETCHES), "date_day", values, ["event_type", "source_relation"], fmt=target.fmt)
    if days and BITMAPS in target.models:
        # numbers are given once: a rerun finds those of a failed run
        number_persons(touched, target.read(spark, NUMBERS)).write.format(target.fmt).mode("append").save(target.path(NUMBERS))
        bits = day_bitmaps(touched, target.read(spark, NUMBERS))
        overwrite_values(spark, bits, target.path(BITMAPS), "date_day", values, ["event_type", "source_relation", "bucket"], fmt=target.fmt)


def _first_key(df: DataFrame) -> DataFrame:
    """``key, value`` of first events."""
    return df.select(surrogate_key("people_id", "source_relation", "event_type").alias("key"), F.col("first_event_day").alias("value"))


def _store_first(spark: SparkSession, first: DataFrame, target: Target) -> None:
    target.write_full(first, FIRST_EVENTS, "first_event_day", FIRST_CLUSTER)
    keyed = target.keyed(spark)
    if keyed is not None:
        keyed.replace(_first_key(target.read(spark, FIRST_EVENTS)))


def first_event_changes(new: DataFrame, stored: DataFrame | KeyedTable) -> DataFrame:
    """First events among ``new`` that the stored ones lack or have later:
    ``people_id, source_relation, event_type, first_event_day, old_day, held``."""
    keys = ["people_id", "source_relation", "event_type"]
    if isinstance(stored, KeyedTable):
        cand = new.select(*keys, F.col("first_event_day").alias("new_day"), surrogate_key(*keys).alias("key"))
        held = stored.rows().select("key", F.col("value").alias("old_day"), F.lit(True).alias("held"))
        met = cand.join(held, "key", "left")
    else:
        cand = new.select(*keys, F.col("first_event_day").alias("new_day"))
        held = stored.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("first_event_day").alias("old_day"), F.lit(True).alias("held"))
        met = cand.join(held, _same_key(keys), "left")
    moved = met.where(F.col("held").isNull() | (F.col("new_day") < F.coalesce("old_day", F.date_add("new_day", 1))))
    return moved.select(*keys, F.col("new_day").alias("first_event_day"), "old_day", "held")


def _same_key(keys: list[str]):
    """Each key equal, null to null, to the column of its name with ``_`` before."""
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return same


def _merge_first(spark: SparkSession, new: DataFrame, target: Target) -> dt.date | None:
    """Merge first events into the stored ones, whose partitions are the first days:
    only partitions that a key enters or leaves are written.  Returns the earliest of these.

    Rows read are all of a day's, or come beside all of it (stored winners), and a
    first day is a minimum, so this equals a scan of all history."""
    keys = ["people_id", "source_relation", "event_type"]
    path = target.path(FIRST_EVENTS)
    if not target.has(spark, FIRST_EVENTS):
        _store_first(spark, new, target)
        return None
    stored, keyed = target.read(spark, FIRST_EVENTS), target.keyed(spark)
    if keyed is not None and not keyed.exists():  # kept by key from now on
        keyed.replace(_first_key(stored))
    changed = first_event_changes(new, stored if keyed is None else keyed)
    with staged_beside(spark, changed, path, fmt=target.fmt) as (changed, _):
        entered = changed.select(F.col("first_event_day").alias("d"))
        left = changed.where("held").select(F.col("old_day").alias("d"))
        days = {r["d"] for r in entered.union(left).distinct().collect()}  # bounded by the calendar
        if not days:
            return None
        hit = F.col("first_event_day").isin(sorted(d for d in days if d is not None))
        if None in days:
            hit = hit | F.col("first_event_day").isNull()
        gone = changed.where("held").select(*[F.col(k).alias(f"_{k}") for k in keys])
        kept = stored.where(hit).join(gone, _same_key(keys), "left_anti")
        both = kept.select(*keys, "first_event_day").unionByName(changed.select(*keys, "first_event_day"))
        values = {NULL_PARTITION if d is None else d.isoformat() for d in days}
        overwrite_values(spark, both, path, "first_event_day", values, FIRST_CLUSTER, fmt=target.fmt)
        if keyed is not None:  # last: a failure before it finds the same changes again
            keyed.upsert(_first_key(changed))
    return min((d for d in days if d is not None), default=None)


def _rewrite_daily(spark: SparkSession, ev: DataFrame, start: dt.date | None, hwm: dt.date, cfg: Config, target: Target) -> None:
    """Daily rows from ``start`` (or where the stored calendar ends, if earlier) on,
    and the mask snapshot of the day before the next lookback window."""
    path = target.path("daily_events")
    ends = [shift_date(dt.date.fromisoformat(v), days=1) for v in partition_values(spark, path, "date_day", target.fmt) if v != NULL_PARTITION]
    start = min([d for d in (start, max(ends, default=None), shift_date(cfg.spine_end, days=1)) if d is not None])
    base, state = _state_before(spark, ev, start, target)
    days = (cfg.spine_end - base).days
    first = target.read(spark, FIRST_EVENTS)
    clamped = cfg.date_range_start is not None and cfg.date_range_start > base
    if days > MAX_RANGE or clamped:
        read_from = shift_date(start, days=-27)
        daily = daily_events(ev.where(F.col("date_day") >= lit_date(read_from)), first_events_of_range(first, read_from), cfg)
    elif days > 0:
        types = target.read(spark, "daily_events").where(F.col("date_day") == lit_date(base)).select("source_relation", "event_type")
        daily = daily_from_state(state, ev, first, types, base, cfg)
    else:
        daily = None
    part, cluster = TABLES["daily_events"]
    if daily is not None:
        rows = daily.where(F.col("date_day") >= lit_date(start))
        overwrite_window(spark, with_descriptions(rows, "daily_events"), path, part, start, cluster, fmt=target.fmt)
    day = shift_date(hwm, days=-cfg.lookback_days - 1) if hwm is not None else base
    if day > base and (day - base).days <= MAX_RANGE:
        _put_snapshot(spark, advance(state, ev, base, day), ACTIVITY_STATE, day, target)
    elif day > base:
        _put_snapshot(spark, state_at(ev, day), ACTIVITY_STATE, day, target)
    elif base != _snapshot_day(spark, ACTIVITY_STATE, target):
        _put_snapshot(spark, state, ACTIVITY_STATE, base, target)


def _state_before(spark: SparkSession, ev: DataFrame, start: dt.date, target: Target) -> tuple[dt.date, DataFrame]:
    """Masks of a day before ``start``, and that day: the snapshot's, or where a day up to
    the snapshot's is touched, the day before it, from 28 days of events."""
    day = _snapshot_day(spark, ACTIVITY_STATE, target)
    if day is not None and day < start:
        return day, _snapshot(spark, ACTIVITY_STATE, day, target)
    day = shift_date(start, days=-1)
    return day, state_at(ev, day)


def _rewrite_monthly(spark: SparkSession, ev: DataFrame, days: set[dt.date], moved: dt.date | None, hwm: dt.date, cfg: Config, target: Target) -> None:
    """Person-months of the touched months, monthly rows from the earliest of them (and
    of ``moved``) on, and the month snapshot of the next lookback window's month."""
    months = sorted({d.replace(day=1) for d in days})
    start = min([*months, *([moved.replace(day=1)] if moved else [])])
    pm_path = target.path(PERSON_MONTHS)
    if target.has(spark, PERSON_MONTHS) and months:
        touched = F.lit(False)
        for m in months:
            touched = touched | F.col("date_day").between(lit_date(m), lit_date(shift_date(m, months=1, days=-1)))
        fresh = person_months(ev.where(touched).select(*MONTHLY_COLUMNS))
        overwrite_values(spark, fresh, pm_path, "date_month", {m.isoformat() for m in months}, PERSON_MONTH_CLUSTER, fmt=target.fmt)
    elif months:
        target.write_full(person_months(ev.select(*MONTHLY_COLUMNS)), PERSON_MONTHS, "date_month", PERSON_MONTH_CLUSTER)
    pm = target.read(spark, PERSON_MONTHS)
    base = _snapshot_day(spark, MONTH_STATE, target)
    if base is not None and base <= start:
        state = _snapshot(spark, MONTH_STATE, base, target)
    else:
        base, state = start, month_state(pm, start)
    first = target.read(spark, FIRST_EVENTS) if cfg.true_new_users else None
    monthly = monthly_from_state(state, pm, target.read(spark, "monthly_events"), base, cfg, first)
    part, cluster = TABLES["monthly_events"]
    rows = monthly.where(F.col("date_month") >= lit_date(start))
    overwrite_window(spark, with_descriptions(rows, "monthly_events"), target.path("monthly_events"), part, start, cluster, fmt=target.fmt)
    month = shift_date(hwm, days=-cfg.lookback_days).replace(day=1) if hwm is not None else base
    if month > base:
        _put_snapshot(spark, advance_months(state, pm, base, month), MONTH_STATE, month, target)
    elif base != _snapshot_day(spark, MONTH_STATE, target):
        _put_snapshot(spark, state, MONTH_STATE, base, target)


# key of every stored table, tested to be unique and not null
TABLE_KEYS = {"event": "unique_event_id", "daily_events": "unique_key", "monthly_events": "unique_key",
              "sessions": "session_id"}


def run_checks(spark: SparkSession, target: str | Target) -> DataFrame:
    """Unique and not-null checks of every stored table's key (Q1, Q2): one
    summary row per check, each a scan of the key column only."""
    frames = []
    target = Target.of(target)
    for table, key in TABLE_KEYS.items():
        if table != "event" and table not in target.models:
            continue
        df = target.read(spark, table).select(key)
        frames += [unique_check(df, key, table), not_null_check(df, key, table)]
    return union_all(frames)
