"""The command-line job builds the same tables as the library calls."""

import json

from eventlens.__main__ import main
from eventlens.plans.catalog import EVENTS_CFG
from eventlens.plans.pipeline import TABLES, run_full
from eventlens.sources import testdata as td
from tests.conftest import SF_SMALL
from tests.helpers import assert_frames_equal


def test_cli_full_then_incremental(spark, tmp_path):
    raw = td.raw_from_events(spark, SF_SMALL)
    landing = str(tmp_path / "raw")
    raw.write.parquet(landing)
    cfg = tmp_path / "options.json"
    cfg.write_text(json.dumps({"source_name": "test.events", "session_timeout_minutes": 30}))
    target = str(tmp_path / "out")
    args = ["--source", landing, "--target", target, "--as-of", "2024-01-30", "--config", str(cfg)]
    main(args + ["--mode", "full"], spark=spark)
    main(args + ["--mode", "incremental", "--check", "--database", "cli_db"], spark=spark)
    assert spark.table("cli_db.event").count() == raw.count()
    expected = str(tmp_path / "expected")
    run_full(spark, raw, EVENTS_CFG, expected)
    for table in TABLES:
        assert_frames_equal(spark.read.parquet(f"{target}/{table}"), spark.read.parquet(f"{expected}/{table}"))


def test_run_checks_summary(spark, tmp_path):
    from eventlens.plans.pipeline import run_checks

    target = str(tmp_path / "t")
    run_full(spark, td.raw_from_events(spark, SF_SMALL), EVENTS_CFG, target)
    rows = run_checks(spark, target).collect()
    assert len(rows) == 8 and all(r["failures"] == 0 for r in rows)


def test_cli_several_named_sources(spark, tmp_path):
    raw = td.raw_from_events(spark, SF_SMALL)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    raw.where("event_id % 2 = 0").write.parquet(a)
    raw.where("event_id % 2 = 1").write.parquet(b)
    target = str(tmp_path / "out")
    main(["--source", f"Conn.A={a}", "--source", f"conn.b={b}", "--target", target, "--as-of", "2024-01-30",
          "--mode", "full"], spark=spark)
    ev = spark.read.parquet(f"{target}/event")
    got = {r["source_relation"]: r["count"] for r in ev.groupBy("source_relation").count().collect()}
    assert set(got) == {"conn.a", "conn.b"} and sum(got.values()) == raw.count()
