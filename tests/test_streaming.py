"""Streaming ingestion: late files (older than the lookback) are picked up
and the tables equal a full refresh over all rows."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from eventlens.config import CustomColumn
from eventlens.operators.dedupe import dedupe_events
from eventlens.operators.staging import stage_events
from eventlens.plans.catalog import EVENTS_CFG
from eventlens.plans.pipeline import TABLES, run_full
from eventlens.sources import testdata as td
from eventlens.sources import sinks
from eventlens.sources.sinks import upsert_files, without_keys, write_full
from eventlens.streaming import dedupe, start_dedupe, start_ingest
from tests.conftest import SF_SMALL
from tests.helpers import assert_frames_equal


def test_stream_batches_equal_full_refresh(spark, tmp_path):
    raw = td.raw_from_events(spark, SF_SMALL)
    schema = raw.schema
    landing, target, ckpt, full = (str(tmp_path / n) for n in ("landing", "target", "ckpt", "full"))
    # first delivery: everything except days 5-9; the late file arrives later
    late = F.to_date("time").between("2024-01-05", "2024-01-09")
    raw.where(~late).write.parquet(f"{landing}/batch1")
    q = start_ingest(spark, f"{landing}/*", schema, EVENTS_CFG, target, ckpt)
    q.awaitTermination(120)
    raw.where(late).write.parquet(f"{landing}/batch2")
    q = start_ingest(spark, f"{landing}/*", schema, EVENTS_CFG, target, ckpt)
    q.awaitTermination(120)
    run_full(spark, raw, EVENTS_CFG, full)
    for table in TABLES:
        assert_frames_equal(spark.read.parquet(f"{target}/{table}"), spark.read.parquet(f"{full}/{table}"))


def test_a_batch_s_keys_do_not_pass_through_the_driver(spark):
    stored = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "k string, v int")
    fresh = spark.createDataFrame([("b", 9), ("c", 9), (None, 9)], "k string, v int")
    kept = without_keys(stored, fresh, "k")
    assert sorted(r["v"] for r in kept.collect()) == [1, 4]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def _stored(spark, path):
    """Rows of two days, in a file for each key and day."""
    for i, (k, v) in enumerate([("a", 1), ("b", 2), (None, 3)]):
        rows = spark.createDataFrame([(k and f"{k}{d}", v, dt.date(2024, 1, d)) for d in (1, 2)], "k string, v int, d date")
        if i:
            rows.coalesce(1).write.mode("append").partitionBy("d").parquet(path)
        else:
            write_full(rows.coalesce(1), path, "d")
    return _files(path)


def _files(path):
    return {f[len(path) + 1:] for f in glob.glob(f"{path}/d=*/*.parquet")}


def _rows(spark, path):
    return sorted((r["k"] or "", r["v"], r["d"].day) for r in spark.read.parquet(path).collect())


def test_an_upsert_rewrites_the_files_with_its_keys_only(spark, tmp_path):
    path = str(tmp_path / "t")
    before = _stored(spark, path)
    fresh = spark.createDataFrame([("a1", 9, dt.date(2024, 1, 1)), ("c1", 9, dt.date(2024, 1, 1)), (None, 9, dt.date(2024, 1, 3))], "k string, v int, d date")
    upsert_files(spark, fresh, path, "k", "d")
    assert _rows(spark, path) == [("", 3, 1), ("", 3, 2), ("", 9, 3), ("a1", 9, 1), ("a2", 1, 2), ("b1", 2, 1), ("b2", 2, 2), ("c1", 9, 1)]
    assert len(before - _files(path)) == 1
    upsert_files(spark, fresh.where("k is not null"), path, "k", "d")  # a batch that is replayed
    assert len(_rows(spark, path)) == 8


def test_rows_that_have_not_changed_are_written_where_they_are_lost(spark, tmp_path):
    path = str(tmp_path / "t")
    before = _stored(spark, path)
    fresh = spark.createDataFrame([("a1", 1, dt.date(2024, 1, 1), False), ("b1", 8, dt.date(2024, 1, 1), True)], "k string, v int, d date, new boolean")
    upsert_files(spark, fresh.where("not new"), path, "k", "d", changed="new")
    assert _files(path) == before
    sinks.drop_partitions(spark, path, "d", {"2024-01-01"})
    upsert_files(spark, fresh, path, "k", "d", changed="new")
    assert _rows(spark, path) == [("", 3, 2), ("a1", 1, 1), ("a2", 1, 2), ("b1", 8, 1), ("b2", 2, 2)]


@pytest.mark.parametrize("at", ["before", "between"])
def test_an_upsert_that_broke_off_is_ended_by_the_next(spark, tmp_path, monkeypatch, at):
    path = str(tmp_path / "t")
    write_full(spark.createDataFrame([(f"k{i}", 1, dt.date(2024, 1, 1)) for i in range(4)], "k string, v int, d date").coalesce(1), path, "d")
    fresh = spark.createDataFrame([("k0", 2, dt.date(2024, 1, 1)), ("n", 2, dt.date(2024, 1, 1))], "k string, v int, d date")
    calls, finish = [], sinks.finish_upsert

    def breaks(s, p):
        calls.append(p)
        if len(calls) == 2:  # the new files are whole, the old ones not gone
            if at == "between":
                monkeypatch.setattr(sinks, "remove", lambda *a: (_ for _ in ()).throw(OSError("off")))
                finish(s, p)
            raise OSError("off")
        finish(s, p)

    with monkeypatch.context():
        monkeypatch.setattr(sinks, "finish_upsert", breaks)
        with pytest.raises(OSError):
            upsert_files(spark, fresh, path, "k", "d")
    monkeypatch.undo()
    upsert_files(spark, fresh, path, "k", "d")
    assert _rows(spark, path) == [("k0", 2, 1), ("k1", 1, 1), ("k2", 1, 1), ("k3", 1, 1), ("n", 2, 1)]
    assert not glob.glob(f"{path}__staging-*") and not glob.glob(f"{path}/_upsert*")


def test_small_files_are_joined_when_there_are_many(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "MANY_FILES", 3)
    path = str(tmp_path / "t")
    write_full(spark.createDataFrame([("k0", 0, dt.date(2024, 1, 1))], "k string, v int, d date"), path, "d")
    for i in range(1, 6):
        upsert_files(spark, spark.createDataFrame([(f"k{i}", i, dt.date(2024, 1, 1))], "k string, v int, d date"), path, "k", "d")
        assert len(_files(path)) <= 3
    assert _rows(spark, path) == [(f"k{i}", i, 1) for i in range(6)]


def _raw(spark, rows):
    schema = "name string, time timestamp_ntz, distinct_id string, insert_id string, loader_row_id string, mp_processing_time_ms bigint, city string, value double"
    return spark.createDataFrame([(n, dt.datetime(2024, 1, d, 1), p, i, r, ms, c, 1.5) for n, d, p, i, r, ms, c in rows], schema)


FIRST = [("View", 1, "p", "i1", "r1", 5, None), ("view", 1, "p", "i1", "r0", 7, "x"), ("view", 2, "p", None, None, None, "y"), ("view", 2, None, "i2", "r3", 1, None)]
SECOND = [("view", 1, "p", "i1", "r2", 9, "z"), ("view", 2, "p", None, "r4", 3, "w"), ("click", 2, "q", "i9", "r5", 1, None)]


@pytest.mark.parametrize("custom", [(), (CustomColumn("v", transform_sql="map('v', value)", alias="m"), CustomColumn("value"))])
def test_a_stream_keeps_its_state_on_disk_and_the_files_that_it_need_not_rewrite(spark, tmp_path, custom):
    cfg = EVENTS_CFG.with_(custom_columns=custom)
    landing, target, progress = (str(tmp_path / n) for n in ("landing", "out", "progress"))
    given = {k: v for k, v in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jsparkSession.conf().getAll()).items()}

    def go(rows, name):
        raw = _raw(spark, rows)
        raw.coalesce(1).write.parquet(f"{landing}/{name}")
        start_dedupe(spark, spark.readStream.schema(raw.schema).parquet(f"{landing}/*"), cfg, target, progress, delay="40 days").awaitTermination(300)
        return set(glob.glob(f"{target}/event/*/*.parquet"))

    one = go(FIRST, "1")
    two = go(SECOND, "2")
    assert len([f for f in one if "2024-01-01" in f]) == 1
    if not custom:  # the first day's winner has not changed
        assert {f for f in one if "2024-01-01" in f} == {f for f in two if "2024-01-01" in f}
    raw = _raw(spark, FIRST + SECOND)
    got, want = spark.read.parquet(f"{target}/event"), dedupe_events(stage_events(raw, cfg), cfg)
    names = [c for c in want.columns if c != "m"]
    assert_frames_equal(got.select(names), want.select(names))
    assert "RocksDBStateStoreProvider" in open(f"{progress}/offsets/0").read()
    assert given == dict(spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jsparkSession.conf().getAll()))


def test_other_settings_write_the_rows_anew(spark, tmp_path):
    landing, target, progress = (str(tmp_path / n) for n in ("landing", "out", "progress"))
    raw = _raw(spark, FIRST)
    for i, day in enumerate(["2024-01-30", "2024-01-31", "2024-01-31"]):
        raw.coalesce(1).write.parquet(f"{landing}/{i}")
        start_dedupe(spark, spark.readStream.schema(raw.schema).parquet(f"{landing}/*"), EVENTS_CFG.with_(as_of_date=day), target, progress, delay="40 days").awaitTermination(300)
        rows = spark.read.parquet(f"{target}/event").collect()
        assert len(rows) == 3 and {r["run_date"].isoformat() for r in rows} == {day}


def test_a_checkpoint_of_whole_rows_goes_on(spark, tmp_path, monkeypatch):
    landing, target, progress = (str(tmp_path / n) for n in ("landing", "out", "progress"))
    provider = "spark.sql.streaming.stateStore.providerClass"
    for i, rows in enumerate([FIRST, SECOND]):
        raw = _raw(spark, rows)
        raw.coalesce(1).write.parquet(f"{landing}/{i}")
        stream = spark.readStream.schema(raw.schema).parquet(f"{landing}/*")
        with monkeypatch.context() as m:
            if i == 0:  # as it was made before
                m.setattr(dedupe, "keeps_packed", lambda *a: False)
                spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
            try:
                start_dedupe(spark, stream, EVENTS_CFG, target, progress, delay="40 days").awaitTermination(300)
            finally:
                spark.conf.unset(provider)
    raw = _raw(spark, FIRST + SECOND)
    assert_frames_equal(spark.read.parquet(f"{target}/event"), dedupe_events(stage_events(raw, EVENTS_CFG), EVENTS_CFG))
