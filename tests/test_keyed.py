"""Bucketed state: no shuffle of the stored side, only touched buckets rewritten."""

import datetime as dt
import pathlib
import re

import pytest
from pyspark.sql import functions as F

from eventlens.operators.staging import stage_events, user_first_events
from eventlens.plans.catalog import EVENTS_CFG
from eventlens.plans.pipeline import FIRST_EVENTS, FIRST_KEYS, Target, first_event_changes, run_full, run_incremental
from eventlens.sources import testdata as td
from eventlens.sources.keyed import KeyedTable
from eventlens.sources.ledger import FileSource, RawFiles
from tests.conftest import SF_SMALL
from tests.helpers import assert_frames_equal


def rows(spark, pairs):
    return spark.createDataFrame([(k, dt.date(2024, 1, d)) for k, d in pairs], "key string, value date")


def files(path):
    return {p.name: p.stat().st_mtime_ns for p in pathlib.Path(path).iterdir() if p.name.startswith("part-")}


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_upsert_rewrites_touched_buckets_only(spark, tmp_path, fmt):
    table = KeyedTable(spark, str(tmp_path / "t"), 8, fmt=fmt)
    assert not table.exists()
    first = {f"k{i}": 10 for i in range(200)}
    table.replace(rows(spark, first.items()))
    before = files(table.path)
    assert len(before) == 8 and {table.bucket(n) for n in before} == set(range(8))
    changed = {"k3": 4, "k77": 9, "new": 2}
    table.upsert(rows(spark, changed.items()))
    after = files(table.path)
    touched = {r[0] for r in rows(spark, changed.items()).select(F.pmod(F.hash("key"), F.lit(8))).collect()}
    assert {table.bucket(n) for n in before.keys() - after.keys()} == touched == {table.bucket(n) for n in after.keys() - before.keys()}
    want = first | changed
    assert {r["key"]: r["value"].day for r in table.rows().collect()} == want
    # another session knows the files only
    spark.sql(f"DROP TABLE {table.name}")
    assert {r["key"]: r["value"].day for r in KeyedTable(spark, table.path, 8, fmt=fmt).rows().collect()} == want


def test_rows_of_a_failed_upsert_do_no_harm(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), 4)
    table.replace(rows(spark, [("a", 9), ("b", 9)]))
    table._write(rows(spark, [("a", 3)]), "append")  # appended, the old file not yet removed
    assert {r["key"]: r["value"].day for r in table.rows().collect()} == {"a": 3, "b": 9}
    table.upsert(rows(spark, [("a", 2), ("c", 5)]))
    assert {r["key"]: r["value"].day for r in table.rows().collect()} == {"a": 2, "b": 9, "c": 5}


def test_merge_does_not_shuffle_the_stored_side(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), 8)
    table.replace(rows(spark, [(f"k{i}", 1) for i in range(50)]))
    new = user_first_events(stage_events(td.raw_from_events(spark, SF_SMALL), EVENTS_CFG))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = first_event_changes(new, table)._jdf.queryExecution().executedPlan().toString()
        plain = user_first_events(stage_events(td.raw_from_events(spark, SF_SMALL), EVENTS_CFG))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    exchanges = len(re.findall(r"Exchange hashpartitioning", text))
    assert exchanges == len(re.findall(r"Exchange hashpartitioning", plain)) + 1  # the new side, by the buckets' key
    stored = text[text.index("Bucketed: true") - 2000 : text.index("Bucketed: true")]
    assert "Exchange" not in stored[stored.rfind("HashAggregate") :]


def test_incremental_first_events_by_key(spark, tmp_path):
    raw = td.raw_from_events(spark, SF_SMALL)
    source = RawFiles({"test.events": FileSource(str(tmp_path / "raw"))})
    target, full = Target(str(tmp_path / "inc"), models=(), state_buckets=8), Target(str(tmp_path / "full"), models=())
    parts = [F.col("event_id") % 5 == 0, (F.col("event_id") % 5 == 1) | F.col("distinct_id").isNull(), F.col("event_id") % 5 > 1]
    for i, part in enumerate(parts):
        raw.where(part).write.parquet(str(tmp_path / "raw" / f"load{i}"))
        (run_full if i == 0 else run_incremental)(spark, source, EVENTS_CFG, target)
    run_full(spark, source, EVENTS_CFG, full)
    assert_frames_equal(target.read(spark, FIRST_EVENTS), full.read(spark, FIRST_EVENTS))
    held = {(r["key"], r["value"]) for r in target.keyed(spark).rows().collect()}
    assert len(held) == full.read(spark, FIRST_EVENTS).count() and {v for _, v in held} == {r[0] for r in full.read(spark, FIRST_EVENTS).select("first_event_day").collect()}
    assert (tmp_path / "inc" / FIRST_KEYS / "buckets=8" / "_SUCCESS").exists()
