"""Incremental runs must give exactly the full-refresh tables (N6, N7 fixed)."""

import datetime as dt
import pathlib

from pyspark.sql import functions as F

from eventlens.plans.catalog import EVENTS_CFG, LATE_CUT
from eventlens.plans.pipeline import FIRST_EVENTS, TABLES, run_full, run_incremental
from eventlens.sources import testdata as td
from eventlens.sources.sinks import delete_insert, high_water_mark, write_full
from tests.conftest import SF_SMALL
from tests.helpers import assert_frames_equal

STORED = [*TABLES, FIRST_EVENTS, "person_months"]


def test_incremental_equals_full(spark, tmp_path):
    raw = td.raw_from_events(spark, SF_SMALL)
    inc, full = str(tmp_path / "inc"), str(tmp_path / "full")
    run_full(spark, raw.where(F.col("loaded_at") < F.lit(LATE_CUT)), EVENTS_CFG, inc)
    start = run_incremental(spark, raw, EVENTS_CFG, inc)
    assert start == dt.date(2024, 1, 17)
    run_full(spark, raw, EVENTS_CFG, full)
    for table in TABLES:
        assert_frames_equal(spark.read.parquet(f"{inc}/{table}"), spark.read.parquet(f"{full}/{table}"))


def test_high_water_mark_capped_at_as_of(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2030, 1, 1), 2)], "date_day date, v int")
    write_full(df, path, "date_day")
    assert high_water_mark(spark, path, "date_day", dt.date(2024, 1, 30)) == dt.date(2024, 1, 30)
    assert high_water_mark(spark, str(tmp_path / "missing"), "date_day") is None


def test_delete_insert_replaces_keys_only(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1), ("b", dt.date(2024, 1, 1), 1),
                                 ("c", dt.date(2024, 1, 2), 1)], "k string, date_day date, v int")
    write_full(old, path, "date_day")
    new = spark.createDataFrame([("a", dt.date(2024, 1, 1), 2), ("d", dt.date(2024, 1, 1), 2)],
                                "k string, date_day date, v int")
    delete_insert(spark, new, path, "k", "date_day")
    got = {(r["k"], r["v"]) for r in spark.read.parquet(path).collect()}
    assert got == {("a", 2), ("b", 1), ("c", 1), ("d", 2)}


def test_incremental_clears_days_that_became_empty(spark, tmp_path):
    raw = td.raw_from_events(spark, SF_SMALL)
    inc, full = str(tmp_path / "inc"), str(tmp_path / "full")
    run_full(spark, raw, EVENTS_CFG, inc)
    cfg = EVENTS_CFG.with_(event_filter="cast(time as date) != date'2024-01-27'")
    run_incremental(spark, raw, cfg, inc)
    run_full(spark, raw, cfg, full)
    ev = spark.read.parquet(f"{inc}/event")
    assert ev.where("date_day = date'2024-01-27'").count() == 0
    for table in STORED:
        if table != FIRST_EVENTS:  # a minimum of all rows ever seen
            assert_frames_equal(spark.read.parquet(f"{inc}/{table}"), spark.read.parquet(f"{full}/{table}"))


def all_equal(spark, inc, full):
    for table in STORED:
        assert_frames_equal(spark.read.parquet(f"{inc}/{table}"), spark.read.parquet(f"{full}/{table}"))
    left = [p.name for p in pathlib.Path(inc).iterdir() if "staging" in p.name]
    assert not left, left


def test_rows_later_than_the_lookback_arrive(spark, tmp_path):
    raw = td.raw_from_events(spark, SF_SMALL)
    late = F.col("event_id") % 7 == 3
    raw = raw.withColumn("loaded_at", F.when(late, F.greatest("loaded_at", F.lit(LATE_CUT))).otherwise(F.col("loaded_at")))
    inc, full = str(tmp_path / "inc"), str(tmp_path / "full")
    run_full(spark, raw.where(F.col("loaded_at") < F.lit(LATE_CUT)), EVENTS_CFG, inc)
    assert run_incremental(spark, raw, EVENTS_CFG, inc) < dt.date(2024, 1, 10)
    run_full(spark, raw, EVENTS_CFG, full)
    all_equal(spark, inc, full)


def test_one_old_row_rewrites_its_own_day_of_events_only(spark, tmp_path):
    raw = td.raw_from_events(spark, SF_SMALL)
    inc = str(tmp_path / "inc")
    old = raw.where("cast(time as date) = date'2024-01-03'").orderBy("event_id").limit(1)
    old_id = old.first()["event_id"]
    run_full(spark, raw.where(F.col("event_id") != old_id), EVENTS_CFG, inc)
    before = {p: p.stat().st_mtime_ns for p in pathlib.Path(f"{inc}/event").rglob("*.parquet")}
    raw2 = raw.withColumn("loaded_at", F.when(F.col("event_id") == old_id, F.lit(dt.datetime(2024, 2, 5))).otherwise(F.col("loaded_at")))
    run_incremental(spark, raw2, EVENTS_CFG, inc)
    after = {p: p.stat().st_mtime_ns for p in pathlib.Path(f"{inc}/event").rglob("*.parquet")}
    rewritten = {p.parent.name for p in before.keys() - after.keys()}
    assert "date_day=2024-01-03" in rewritten
    assert {d for d in rewritten if d < "date_day=2024-01-20"} == {"date_day=2024-01-03"}


def test_emptied_month(spark, tmp_path):
    from eventlens.plans.catalog import ORDERS_CFG

    raw = td.raw_from_orders(spark, SF_SMALL).where("time >= timestamp'1999-08-01'")  # two years: each date is a folder
    last = raw.agg(F.date_trunc("month", F.max("time")).cast("date")).first()[0]
    cfg = ORDERS_CFG.with_(lookback_days=40)
    inc, full = str(tmp_path / "inc"), str(tmp_path / "full")
    run_full(spark, raw, cfg, inc)
    without = cfg.with_(event_filter=f"time < timestamp'{last}'")
    run_incremental(spark, raw, without, inc)
    run_full(spark, raw, without, full)
    assert spark.read.parquet(f"{inc}/monthly_events").where(F.col("date_month") >= F.lit(last)).count() == 0
    for table in ("event", "daily_events", "monthly_events", "sessions", "person_months"):
        assert_frames_equal(spark.read.parquet(f"{inc}/{table}"), spark.read.parquet(f"{full}/{table}"))


def test_missing_state_is_rebuilt_and_stored(spark, tmp_path):
    raw = td.raw_from_events(spark, SF_SMALL)
    inc, full = str(tmp_path / "inc"), str(tmp_path / "full")
    run_full(spark, raw.where(F.col("loaded_at") < F.lit(LATE_CUT)), EVENTS_CFG, inc)
    for table in (FIRST_EVENTS, "person_months"):
        pathlib.Path(f"{inc}/{table}/_SUCCESS").unlink()
    run_incremental(spark, raw, EVENTS_CFG, inc)
    assert pathlib.Path(f"{inc}/{FIRST_EVENTS}/_SUCCESS").exists() and pathlib.Path(f"{inc}/person_months/_SUCCESS").exists()
    run_full(spark, raw, EVENTS_CFG, full)
    all_equal(spark, inc, full)


def test_every_write_is_split(spark, tmp_path):
    """With one source and more partitions than dates, no date is written by one task alone."""
    raw = td.raw_from_events(spark, SF_SMALL).where("cast(time as date) >= date'2024-01-24'")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        run_full(spark, raw, EVENTS_CFG, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for table, part in (("event", "date_day"), ("sessions", "session_started_on_day"), ("person_months", "date_month")):
        folders = [p for p in (tmp_path / table).iterdir() if p.name.startswith(part)]
        assert folders and all(len(list(p.glob("*.parquet"))) > 1 for p in folders), table


def test_delete_insert_strategy_equals_full(spark, tmp_path):
    raw = td.raw_from_events(spark, SF_SMALL)
    inc, full = str(tmp_path / "inc"), str(tmp_path / "full")
    run_full(spark, raw.where(F.col("loaded_at") < F.lit(LATE_CUT)), EVENTS_CFG, inc)
    run_incremental(spark, raw, EVENTS_CFG, inc, strategy="delete+insert")
    run_full(spark, raw, EVENTS_CFG, full)
    for table in TABLES:
        assert_frames_equal(spark.read.parquet(f"{inc}/{table}"), spark.read.parquet(f"{full}/{table}"))


def test_config_validation():
    import pytest

    from eventlens.config import Config

    with pytest.raises(ValueError):
        Config(session_timeout_minutes=-1)


def test_incremental_equals_full_on_long_history(spark, tmp_path):
    from eventlens.plans.catalog import ORDERS_CFG

    raw = td.raw_from_orders(spark, SF_SMALL).where("time >= timestamp'1999-08-01'")  # two years: each date is a folder
    inc, full = str(tmp_path / "inc"), str(tmp_path / "full")
    run_full(spark, raw.where(F.col("time") < F.lit(dt.datetime(2001, 7, 15))), ORDERS_CFG, inc)
    start = run_incremental(spark, raw, ORDERS_CFG, inc)
    assert start < dt.date(2001, 7, 15)
    run_full(spark, raw, ORDERS_CFG, full)
    for table in [*TABLES, "user_first_event", "person_months"]:
        assert_frames_equal(spark.read.parquet(f"{inc}/{table}"), spark.read.parquet(f"{full}/{table}"))


def two_connections(raw):
    """One connection with load times, one that lags behind by years."""
    lag = raw.withColumn("source_relation", F.lit("slow")).withColumn("loaded_at", F.col("loaded_at") - F.expr("interval 3 years"))
    return raw.withColumn("source_relation", F.lit("fast")).unionByName(lag)


def late_rows_arrive(spark, tmp_path, raw, unseen):
    inc, full = str(tmp_path / "inc"), str(tmp_path / "full")
    run_full(spark, raw.where(~unseen), EVENTS_CFG, inc)
    assert run_incremental(spark, raw, EVENTS_CFG, inc) < dt.date(2024, 1, 10)
    run_full(spark, raw, EVENTS_CFG, full)
    all_equal(spark, inc, full)


def old_rows():
    return F.expr("event_id % 7 = 3 and cast(time as date) < date'2024-01-12'")


def test_late_rows_of_a_connection_that_lags(spark, tmp_path):
    late_rows_arrive(spark, tmp_path, two_connections(td.raw_from_events(spark, SF_SMALL)), old_rows() & (F.col("source_relation") == "slow"))


def test_late_rows_without_load_time(spark, tmp_path):
    raw = two_connections(td.raw_from_events(spark, SF_SMALL))
    raw = raw.withColumn("loaded_at", F.when(F.col("source_relation") == "fast", F.col("loaded_at")))
    late_rows_arrive(spark, tmp_path, raw, old_rows() & (F.col("source_relation") == "slow"))


def test_late_rows_after_a_future_load_time(spark, tmp_path):
    raw = td.raw_from_events(spark, SF_SMALL)
    later = dt.datetime.now() + dt.timedelta(minutes=30)  # one value for all runs, after the first
    future = F.when(F.col("event_id") % 100 == 1, F.lit(dt.datetime(2999, 1, 1))).when(old_rows(), F.lit(later))
    late_rows_arrive(spark, tmp_path, raw.withColumn("loaded_at", F.coalesce(future, "loaded_at")), old_rows())
