"""Incremental runs over raw files: only new files are read, and the tables equal a full refresh."""

import datetime as dt
import os
import pathlib

import pytest
from pyspark.sql import functions as F

from eventlens.config import CustomColumn
from eventlens.plans.catalog import EVENTS_CFG, LATE_CUT, ORDERS_CFG
from eventlens.plans.pipeline import FIRST_EVENTS, LEDGER, TABLES, Target, run_full, run_incremental
from eventlens.sources import testdata as td
from eventlens.sources.ledger import FileSource, RawFiles
from tests.conftest import SF_SMALL
from tests.helpers import assert_frames_equal

STORED = [*TABLES, FIRST_EVENTS, "person_months"]


def files_of(tmp_path, *names):
    return RawFiles({n: FileSource(str(tmp_path / "raw" / n)) for n in names or ("test.events",)})


def load(df, tmp_path, part, name="test.events"):
    df.write.mode("overwrite").parquet(str(tmp_path / "raw" / name / part))


def equals_full(spark, files, cfg, tmp_path, inc, fmt="parquet"):
    full = Target(str(tmp_path / "full"), fmt)
    run_full(spark, files, cfg, full)
    inc = inc if isinstance(inc, Target) else Target(inc)
    for table in STORED:
        assert_frames_equal(inc.read(spark, table), full.read(spark, table))
    left = [p.name for p in pathlib.Path(inc.root).iterdir() if "staging" in p.name]
    assert not left, left


def spoil(folder):
    """Overwrite every data file's pages; footer, size and time stay, so only a reader of rows notices."""
    for p in pathlib.Path(folder).rglob("*.parquet"):
        st, raw = p.stat(), p.read_bytes()
        crc = p.with_name(f".{p.name}.crc")
        if crc.exists():
            crc.unlink()
        footer = int.from_bytes(raw[-8:-4], "little") + 8
        p.write_bytes(raw[:4] + b"x" * (len(raw) - footer - 4) + raw[-footer:])
        os.utime(p, ns=(st.st_atime_ns, st.st_mtime_ns))


def unseen():
    return (F.col("loaded_at") >= F.lit(LATE_CUT)) | (F.col("event_id") % 11 == 3)


def test_old_files_are_not_read(spark, tmp_path):
    raw, inc = td.raw_from_events(spark, SF_SMALL), str(tmp_path / "inc")
    files = files_of(tmp_path)
    load(raw.where(~unseen()), tmp_path, "first")
    run_full(spark, files, EVENTS_CFG, inc)
    load(raw.where(unseen()), tmp_path, "second")
    spoil(tmp_path / "raw" / "test.events" / "first")
    assert run_incremental(spark, files, EVENTS_CFG, inc) < dt.date(2024, 1, 5)
    load(raw.where(~unseen()), tmp_path / "again", "first")
    load(raw.where(unseen()), tmp_path / "again", "second")
    equals_full(spark, files_of(tmp_path / "again"), EVENTS_CFG, tmp_path, inc)
    assert run_incremental(spark, files, EVENTS_CFG, inc) is None  # nothing new


def test_a_day_reads_the_state_and_that_day_only(spark, tmp_path):
    """With the last two days new, event partitions before the snapshot are not read."""
    raw, inc = td.raw_from_events(spark, SF_SMALL), str(tmp_path / "inc")
    files, cfg = files_of(tmp_path), EVENTS_CFG.with_(lookback_days=0)
    last = raw.agg(F.max(F.to_date("time"))).first()[0]
    cut = F.to_date("time") >= F.lit(last)
    load(raw.where(~cut), tmp_path, "first")
    run_full(spark, files, cfg, inc)
    load(raw.where(cut), tmp_path, "second")
    older = [p for p in pathlib.Path(f"{inc}/event").iterdir() if "date_day=" in p.name and p.name < f"date_day={last - dt.timedelta(days=1)}"]
    target = Target(inc, models=("daily_events",))
    for folder in older:
        spoil(folder)
    assert run_incremental(spark, files, cfg, target) == last
    full = Target(str(tmp_path / "full"))
    run_full(spark, files, cfg, full)
    assert_frames_equal(target.read(spark, "daily_events"), full.read(spark, "daily_events"))


@pytest.mark.parametrize("times", ["lagging", "null", "future"])
def test_load_times_do_not_matter(spark, tmp_path, times):
    raw, inc = td.raw_from_events(spark, SF_SMALL), str(tmp_path / "inc")
    value = {"lagging": F.col("loaded_at") - F.expr("interval 3 years"), "null": F.lit(None).cast("timestamp"),
             "future": F.lit(dt.datetime(2999, 1, 1))}[times]
    slow = raw.withColumn("loaded_at", value)
    files = files_of(tmp_path, "fast", "slow")
    load(raw, tmp_path, "all", "fast")
    load(slow.where(~unseen()), tmp_path, "first", "slow")
    run_full(spark, files, EVENTS_CFG, inc)
    load(slow.where(unseen()), tmp_path, "second", "slow")
    run_incremental(spark, files, EVENTS_CFG, inc)
    equals_full(spark, files, EVENTS_CFG, tmp_path, inc)


def test_duplicates_meet_the_stored_winner(spark, tmp_path):
    """A second load repeats events, with earlier and later processing times, and more columns."""
    raw, inc = td.raw_from_events(spark, SF_SMALL), str(tmp_path / "inc")
    cfg = EVENTS_CFG.with_(properties_to_pivot=("k",), custom_columns=(CustomColumn("value"),))
    shift = F.when(F.col("event_id") % 2 == 0, -(10**9)).otherwise(10**9)
    again = raw.where("event_id % 3 = 1").withColumn("mp_processing_time_ms", F.col("mp_processing_time_ms") + shift).withColumn("city", F.lit("x"))
    files = files_of(tmp_path)
    load(raw.drop("properties"), tmp_path, "first")
    run_full(spark, files, cfg, inc)
    load(again, tmp_path, "second")
    run_incremental(spark, RawFiles({"test.events": FileSource(str(tmp_path / "raw" / "test.events"), options={"mergeSchema": "true"})}), cfg, inc)
    merged = RawFiles({"test.events": FileSource(str(tmp_path / "raw" / "test.events"), options={"mergeSchema": "true"})})
    equals_full(spark, merged, cfg, tmp_path, inc)


def test_files_that_vanish_or_change(spark, tmp_path):
    raw, inc = td.raw_from_events(spark, SF_SMALL), str(tmp_path / "inc")
    files = files_of(tmp_path)
    parts = {n: raw.where(F.col("event_id") % 4 == i) for i, n in enumerate("abcd")}
    for n, df in parts.items():
        load(df, tmp_path, n)
    run_full(spark, files, EVENTS_CFG, inc)
    for p in (tmp_path / "raw" / "test.events" / "b").iterdir():
        p.unlink()
    load(parts["c"].where("event_id % 8 = 2"), tmp_path, "c")
    run_incremental(spark, files, EVENTS_CFG, inc)
    equals_full(spark, files, EVENTS_CFG, tmp_path, inc)


def test_missing_state_is_rebuilt(spark, tmp_path):
    raw, inc = td.raw_from_events(spark, SF_SMALL), str(tmp_path / "inc")
    files = files_of(tmp_path)
    load(raw.where(~unseen()), tmp_path, "first")
    run_full(spark, files, EVENTS_CFG, inc)
    for marker in [*(tmp_path / "inc").glob("user_first_event/_SUCCESS"), *(tmp_path / "inc").glob("*_state/*/_SUCCESS"), tmp_path / "inc" / "person_months" / "_SUCCESS"]:
        marker.unlink()
    load(raw.where(unseen()), tmp_path, "second")
    run_incremental(spark, files, EVENTS_CFG, inc)
    equals_full(spark, files, EVENTS_CFG, tmp_path, inc)


def test_first_days_before_the_date_range(spark, tmp_path):
    raw, inc = td.raw_from_events(spark, SF_SMALL), str(tmp_path / "inc")
    cfg = EVENTS_CFG.with_(date_range_start="2024-01-10")
    files = files_of(tmp_path)
    early = F.col("time") < F.lit(dt.datetime(2024, 1, 8))
    load(raw.where(~early), tmp_path, "first")
    run_full(spark, files, cfg, inc)
    load(raw.where(early), tmp_path, "second")
    run_incremental(spark, files, cfg, inc)
    equals_full(spark, files, cfg, tmp_path, inc)


def test_long_history_and_later_runs(spark, tmp_path):
    """Four loads of eight months of orders; every run's as-of date is later."""
    raw, inc = td.raw_from_orders(spark, SF_SMALL).where("time >= timestamp'2000-12-01'"), str(tmp_path / "inc")
    files = files_of(tmp_path)
    cuts = [dt.datetime(2001, 6, 20), dt.datetime(2001, 7, 10), dt.datetime(2001, 7, 20), dt.datetime(2100, 1, 1)]
    old = F.col("mp_processing_time_ms") % 97 == 5
    for i, (lo, hi) in enumerate(zip([dt.datetime(1900, 1, 1), *cuts], cuts, strict=False)):
        cfg = ORDERS_CFG.with_(as_of_date=min(hi.date(), ORDERS_CFG.as_of_date))
        inside = (F.col("time") >= F.lit(lo)) & (F.col("time") < F.lit(hi))
        load(raw.where(((inside & ~old) | (old & F.lit(i == 3)))), tmp_path, f"load{i}")
        run_incremental(spark, files, cfg, inc)
    full = Target(str(tmp_path / "full"))
    run_full(spark, files, cfg, full)
    for table in STORED:
        drop = ["run_date"] if table != FIRST_EVENTS and table != "person_months" else []
        assert_frames_equal(Target(inc).read(spark, table).drop(*drop), full.read(spark, table).drop(*drop))


def test_other_settings_rebuild_and_other_formats(spark, tmp_path):
    raw = td.raw_from_events(spark, SF_SMALL)
    files, inc = files_of(tmp_path), Target(str(tmp_path / "inc"), "orc")
    load(raw.where(~unseen()), tmp_path, "first")
    run_full(spark, files, EVENTS_CFG, inc)
    load(raw.where(unseen()), tmp_path, "second")
    assert run_incremental(spark, files, EVENTS_CFG, inc) is not None
    equals_full(spark, files, EVENTS_CFG, tmp_path, inc, "orc")
    cfg = EVENTS_CFG.with_(event_filter="name != 'error'")
    assert run_incremental(spark, files, cfg, inc) is None
    assert inc.read(spark, "event").where("event_type = 'error'").isEmpty()


def test_ledger_names_files_days_and_sizes(spark, tmp_path):
    raw, inc = td.raw_from_events(spark, SF_SMALL), Target(str(tmp_path / "inc"), models=())
    files = files_of(tmp_path)
    load(raw.where("event_id % 2 = 0").coalesce(1), tmp_path, "first")
    run_full(spark, files, EVENTS_CFG, inc)
    load(raw.limit(0), tmp_path, "empty")
    run_incremental(spark, files, EVENTS_CFG, inc)
    rows = inc.read(spark, LEDGER).collect()
    on_disk = {str(p): p.stat().st_size for p in (tmp_path / "raw").rglob("*.parquet")}
    assert {r["path"].removeprefix("file:"): r["length"] for r in rows} == on_disk
    assert sorted(len(r["days"]) == 0 for r in rows) == [False, True]
    assert not (tmp_path / "inc" / "daily_events").exists()
