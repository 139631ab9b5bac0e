"""State operators, mergeable counts, checksums, SQL function, catalog and stateful stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventlens.operators import distinct, quality
from eventlens.operators import daily as daily_ops
from eventlens.operators.activity_state import MAX_RANGE, advance, daily_from_state, state_at
from eventlens.operators.dedupe import dedupe_events
from eventlens.operators.funnel import analyze_funnel, register_funnel
from eventlens.operators.month_state import month_state, monthly_from_state
from eventlens.operators.monthly import monthly_from_person_months, person_months
from eventlens.operators.staging import stage_events, user_first_events
from eventlens.plans.catalog import EVENTS_CFG, ORDERS_CFG
from eventlens.plans.docs import DESCRIPTIONS
from eventlens.plans.pipeline import Target, run_full, run_incremental
from eventlens.plans.publish import publish
from eventlens.sources import testdata as td
from eventlens.sources.ledger import FileSource, RawFiles
from eventlens.streaming import start_dedupe
from tests.conftest import SF_SMALL
from tests.helpers import assert_frames_equal
from tests.test_plans import plan_text


@pytest.fixture(scope="module")
def events(spark):
    stg = stage_events(td.raw_from_events(spark, SF_SMALL), EVENTS_CFG)
    return stg, dedupe_events(stg, EVENTS_CFG)


@pytest.mark.parametrize("day", [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 1, 20), dt.date(2024, 2, 4)])
def test_masks_of_any_day_give_the_sweep(spark, events, day):
    stg, ev = events
    first = user_first_events(stg)
    known = first.where(F.col("first_event_day") <= F.lit(day)).select("source_relation", "event_type").distinct()
    cfg = EVENTS_CFG if (EVENTS_CFG.spine_end - day).days <= MAX_RANGE else EVENTS_CFG.with_(as_of_date=day + dt.timedelta(days=MAX_RANGE - 6))
    got = daily_from_state(state_at(ev, day), ev.where(F.col("date_day") > F.lit(day)), first, known, day, cfg)
    want = daily_ops.daily_events(ev, first, cfg).where(F.col("date_day") > F.lit(day))
    assert_frames_equal(got, want)


def test_masks_move_on(spark, events):
    """One day on, 28 and 34 days on; persons who stay away leave the state."""
    _, ev = events
    ev = ev.where("people_id % 3 != 0 or date_day < date'2024-01-03'")
    for a, b in ((dt.date(2024, 1, 2), dt.date(2024, 1, 3)), (dt.date(2024, 1, 2), dt.date(2024, 1, 30)), (dt.date(2024, 1, 2), dt.date(2024, 2, 5))):
        assert_frames_equal(advance(state_at(ev, a), ev, a, b), state_at(ev, b).where("mask != 0"))
    with pytest.raises(ValueError):
        advance(state_at(ev, dt.date(2024, 1, 1)), ev, dt.date(2024, 1, 1), dt.date(2024, 3, 1))


def test_masks_need_no_window_and_no_early_events(spark, tmp_path, events):
    stg, ev = events
    day = dt.date(2024, 1, 25)
    ev.select("people_id", "event_type", "source_relation", "date_day").write.partitionBy("date_day").parquet(str(tmp_path / "ev"))
    state_at(ev, day).write.parquet(str(tmp_path / "state"))
    stored = spark.read.parquet(str(tmp_path / "ev"))
    known = stored.select("source_relation", "event_type").limit(0)
    text = plan_text(daily_from_state(spark.read.parquet(str(tmp_path / "state")), stored, user_first_events(stg), known, day, EVENTS_CFG))
    assert "Window" not in text and "PartitionFilters: [isnotnull(date_day" in text


@pytest.mark.parametrize("mode", ["previous_row", "previous_month"])
@pytest.mark.parametrize("true_new", [False, True])
def test_month_state_gives_all_windows(spark, mode, true_new):
    cfg = ORDERS_CFG.with_(churn_mode=mode, true_new_users=true_new, date_range_start="1996-03-10")
    stg = stage_events(td.raw_from_orders(spark, SF_SMALL), cfg)
    first, pm = user_first_events(stg), person_months(dedupe_events(stg, cfg, columns=["source_relation", "people_id", "event_type", "occurred_at"]))
    pm = pm.where("date_month != date'1998-05-01'")  # a month without events
    whole = monthly_from_person_months(pm, cfg, first)
    for month in (dt.date(1990, 1, 1), dt.date(1998, 6, 1), dt.date(2001, 7, 1)):
        since = F.col("date_month") >= F.lit(month)
        got = monthly_from_state(month_state(pm, month), pm.where(since), whole.where(~since), month, cfg, first)
        assert_frames_equal(got, whole.where(since))


def test_sketches_and_bitmaps_follow_loads(spark, tmp_path):
    raw = td.raw_from_events(spark, SF_SMALL)
    files = RawFiles({"test.events": FileSource(str(tmp_path / "raw"))})
    inc = Target(str(tmp_path / "inc"), models=("user_sketches", "user_bitmaps"))
    raw.where("event_id % 3 != 1").write.parquet(str(tmp_path / "raw/a"))
    run_full(spark, files, EVENTS_CFG, inc)
    raw.where("event_id % 3 = 1").write.parquet(str(tmp_path / "raw/b"))
    run_incremental(spark, files, EVENTS_CFG, inc)
    ev = inc.read(spark, "event")
    exact = ev.groupBy("event_type").agg(F.count_distinct("people_id").alias("number_of_users"))
    assert_frames_equal(distinct.bitmap_users(inc.read(spark, "user_bitmaps"), "event_type"), exact)
    numbers = inc.read(spark, "person_numbers")
    assert numbers.count() == numbers.select("people_id").distinct().count() == numbers.select("person_no").distinct().count()
    near = distinct.sketched_users(inc.read(spark, "user_sketches").where("date_day > date'2024-01-11'"), "event_type")
    want = ev.where("date_day > date'2024-01-11'").groupBy("event_type").agg(F.count_distinct("people_id").alias("n"))
    for r in near.join(want, "event_type").collect():
        assert abs(r["approx_users"] - r["n"]) <= 1 + 4 * distinct.sketch_error() * r["n"]


def test_checksums_find_what_differs(spark, tmp_path):
    rows = [(dt.date(2024, 1, d), i, None if i % 5 == 0 else f"v{i % 3}") for d in range(1, 6) for i in range(40)]
    prod = spark.createDataFrame([*rows, (None, 1, "x")], "day date, a int, b string")
    changed = [r for r in rows if r != (dt.date(2024, 1, 2), 7, "v1")] + [(dt.date(2024, 1, 7), 1, None)]
    swapped = [(d, i, b) if (d.day, i) != (4, 5) else (d, None, "5") for d, i, b in changed]
    dev = spark.createDataFrame([*swapped, (None, 1, "y")], "day date, a int, b string").repartition(5)
    days = {r[0] for r in quality.differing_partitions(prod, dev, "day").collect()}
    assert days == {None, dt.date(2024, 1, 2), dt.date(2024, 1, 4), dt.date(2024, 1, 7)}
    assert_frames_equal(quality.compare_partitions(prod, dev, "day"), quality.compare_row_sets(prod, dev))
    assert quality.compare_partitions(prod, prod.repartition(3), "day").isEmpty()
    for name, df in (("p", prod), ("d", dev)):
        df.write.partitionBy("day").parquet(str(tmp_path / name))
    stored = quality.compare_partitions(*[spark.read.parquet(str(tmp_path / n)) for n in "pd"], "day")
    assert "PartitionFilters: [(day" in plan_text(stored) and stored.count() == quality.compare_row_sets(prod, dev).count()


def test_funnel_as_table_function(spark, events):
    _, ev = events
    name = register_funnel(spark, ev, "test_funnel", "date_trunc('week', date_day)")
    got = spark.sql(f"SELECT * FROM {name}(array('VIEW', 'click', 'purchase'))").where("segment = '2024-01-08 00:00:00'").drop("segment")
    week = ev.where("date_day between date'2024-01-08' and date'2024-01-14'")
    assert_frames_equal(got, analyze_funnel(week, ["view", "click", "purchase"]))
    often = spark.sql(f"SELECT sum(number_of_users) FROM {name}(array('view'), 2)").first()[0]
    assert often == week.sparkSession.sql("SELECT count(*) FROM (SELECT date_trunc('week', date_day), people_id FROM test_funnel_events WHERE event_type = 'view' AND people_id IS NOT NULL GROUP BY ALL HAVING count(*) >= 2)").first()[0]
    with pytest.raises(ValueError):
        register_funnel(spark, ev, "x; drop")


def test_catalog_names_comments_and_new_partitions(spark, tmp_path):
    raw = td.raw_from_events(spark, SF_SMALL)
    files, target = RawFiles({"test.events": FileSource(str(tmp_path / "raw"))}), Target(str(tmp_path / "out"), models=("daily_events",))
    raw.where("time < timestamp'2024-01-20'").write.parquet(str(tmp_path / "raw/a"))
    run_full(spark, files, EVENTS_CFG, target)
    assert set(publish(spark, target, "test_db", "x_")) == {"test_db.x_event", "test_db.x_daily_events", "test_db.x_user_first_event"}
    before = spark.table("test_db.x_event").count()
    raw.where("time >= timestamp'2024-01-20'").write.parquet(str(tmp_path / "raw/b"))
    run_incremental(spark, files, EVENTS_CFG, target)
    publish(spark, target, "test_db", "x_")
    assert before < spark.table("test_db.x_event").count() == raw.count()
    assert_frames_equal(spark.table("test_db.x_daily_events"), target.read(spark, "daily_events"))
    shown = {r["col_name"]: r["comment"] for r in spark.sql("DESCRIBE test_db.x_event").collect() if not r["col_name"].startswith("#")}
    assert shown == {c: DESCRIPTIONS["event"][c] for c in target.read(spark, "event").columns}
    assert all(DESCRIPTIONS["daily_events"].get(c) for c in target.read(spark, "daily_events").columns)


def test_one_parse_for_all_properties(spark):
    cfg = EVENTS_CFG.with_(properties_to_pivot=("k", "it's", "x.y", "no"), pivot_method="variant")
    raw = td.raw_from_events(spark, SF_SMALL).withColumn("properties", F.expr(
        "CASE event_id % 5 WHEN 0 THEN properties WHEN 1 THEN '{\"it\\'s\": \"q\", \"x.y\": {\"a\": 1}, \"k\": true}' WHEN 2 THEN 'not json' WHEN 3 THEN NULL ELSE '{\"k\": null}' END"))
    ev = dedupe_events(stage_events(raw, cfg), cfg)
    text = plan_text(ev.select("unique_event_id", "k", "`it's`", "x_y", "no"))
    assert text.count("parseJson") == 1 and text.count("try_variant_get") == 4
    names = ["unique_event_id", "k", "x_y", "no"]
    assert_frames_equal(ev.select(*names), dedupe_events(stage_events(raw, cfg), cfg.with_(pivot_method="json")).select(*names))
    assert {r[0] for r in ev.select("`it's`").distinct().collect()} == {None, "q"}


def test_stateful_dedupe_out_of_order_late_and_restarted(spark, tmp_path):
    raw = td.raw_from_events_redelivered(spark, SF_SMALL)
    landing, target, progress = str(tmp_path / "landing"), str(tmp_path / "out"), str(tmp_path / "progress")

    def go():
        stream = spark.readStream.schema(raw.schema).parquet(f"{landing}/*")
        start_dedupe(spark, stream, EVENTS_CFG, target, progress, delay="40 days").awaitTermination(300)

    later = F.col("loader_row_id").endswith("-r")
    raw.where(later & (F.col("event_id") % 2 == 0)).write.parquet(f"{landing}/1")  # losers first
    go()
    raw.where(~later & (F.col("time") >= F.lit(dt.datetime(2024, 1, 15)))).write.parquet(f"{landing}/2")
    go()  # a new query from the checkpoint
    raw.where((~later & (F.col("time") < F.lit(dt.datetime(2024, 1, 15)))) | (later & (F.col("event_id") % 2 == 1))).write.parquet(f"{landing}/3")
    go()
    want = dedupe_events(stage_events(raw, EVENTS_CFG), EVENTS_CFG)
    got = spark.read.parquet(f"{target}/event")
    assert_frames_equal(got, want)
    # beyond the watermark: dropped
    raw.limit(1).withColumn("time", F.lit(dt.datetime(2023, 6, 1))).write.parquet(f"{landing}/4")
    go()
    assert_frames_equal(spark.read.parquet(f"{target}/event"), want)
