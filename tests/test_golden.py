"""Golden cases on hand-built rows, checked two ways: explicit expected
values, and every model against independent DuckDB SQL."""

import datetime as dt

import duckdb
import pytest

from eventlens.config import Config
from eventlens.operators import daily as daily_ops
from eventlens.operators.dedupe import dedupe_events
from eventlens.operators.funnel import analyze_funnel
from eventlens.operators.monthly import monthly_events
from eventlens.operators.sessions import sessionized_events, sessions
from eventlens.operators.staging import stage_events, user_first_events
from eventlens.plans import oracle as O
from tests.fixtures import AS_OF, PRESENT, raw_fixture
from tests.helpers import assert_frames_equal, assert_same

CFG = Config(as_of_date=AS_OF)


@pytest.fixture(scope="module")
def models(spark):
    stg = stage_events(raw_fixture(spark), CFG)
    ev = dedupe_events(stg, CFG)
    first = user_first_events(stg)
    return {"stg": stg, "ev": ev, "first": first}


@pytest.fixture(scope="module")
def fduck(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fixture") / "raw.parquet")
    raw_fixture(spark).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW fixture_raw AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return con


def base_ctes(start=None):
    return O.stg_ctes("", "SELECT * FROM fixture_raw", PRESENT, None) + O.ev_ctes("", AS_OF, start)


def test_missing_columns_are_typed_nulls(models):
    row = models["stg"].where("loader_row_id = 'f01'").first()
    assert row["os"] is None and row["screen_width"] is None and row["has_wifi_connected"] is None
    assert row["event_type_original_casing"] == "Play" and row["event_type"] == "play"
    assert row["people_id"] == "p1" and row["occurred_at"] == dt.datetime(2024, 3, 1, 10)
    assert dict(models["stg"].dtypes)["occurred_at"] == "timestamp_ntz"


def test_dedupe_golden(models):
    kept = {r["loader_row_id"] for r in models["ev"].select("loader_row_id").collect()}
    assert {"f01", "f02"} <= kept          # same insert id on two days: both kept
    assert "f03" in kept and "f04" not in kept  # later processing time dropped
    assert "f06" in kept and "f05" not in kept  # NULL insert ids collapse, smallest processing time wins
    assert "f08" in kept and "f07" not in kept  # NULL processing time sorts last
    assert "f22" in kept                   # other connection is never merged
    assert models["ev"].count() == len(kept) == 20


def test_event_table_matches_oracle(models, fduck):
    assert_same(models["ev"], fduck.sql(O.with_(base_ctes(), "SELECT * FROM ev")))


def test_sessions_golden(models):
    s = sessions(models["ev"], CFG)
    p4 = s.where("people_id = 'p4'").orderBy("session_started_at").collect()
    assert [r["total_number_of_events"] for r in p4] == [2, 1]
    p5 = s.where("people_id = 'p5'").collect()
    assert len(p5) == 2 and {r["session_started_on_day"] for r in p5} == {dt.date(2024, 3, 9), dt.date(2024, 3, 10)}
    p3 = s.where("people_id = 'p3'").collect()
    assert len(p3) == 1 and p3[0]["event_frequencies"] == "{click: 1, view: 1}"
    anon = s.where("user_id = 'dev9'").collect()
    assert len(anon) == 1 and anon[0]["people_id"] is None and anon[0]["device_id"] == "dev9"
    assert s.where("user_id is null").count() == 1


@pytest.mark.parametrize("timeout", [30, 31, 360])
def test_sessions_match_oracle(models, fduck, timeout):
    cfg = CFG.with_(session_timeout_minutes=timeout)
    ctes = base_ctes() + O.session_ctes("", AS_OF, timeout=timeout)
    assert_same(sessions(models["ev"], cfg), fduck.sql(O.with_(ctes, "SELECT * FROM sessions")))
    per_event = sessionized_events(models["ev"], cfg).select(
        "unique_event_id", "previous_event_at", "is_new_session", "session_number", "session_id",
        "number_of_this_event_type", "total_number_of_events", "session_started_at")
    assert_same(per_event, fduck.sql(O.with_(ctes, "SELECT unique_event_id, previous_event_at, is_new_session, "
                                                   "CAST(session_number AS BIGINT) AS session_number, session_id, "
                                                   "number_of_this_event_type, total_number_of_events, "
                                                   "session_started_at FROM session_ids")))


def test_monthly_golden(models):
    m = monthly_events(models["ev"], CFG)
    may = m.where("event_type = 'buy' and date_month = date'2024-05-01'").first()
    assert may["number_of_return_users"] == 1 and may["number_of_repeat_users"] == 0
    assert may["number_of_churn_users"] == 1 and may["number_of_new_users"] == 0
    view = m.where("event_type = 'view' and date_month = date'2024-03-01'").first()
    assert view["number_of_events"] == 4 and view["number_of_users"] == 2  # NULL persons add events only


def test_monthly_matches_oracle(models, fduck):
    ctes = base_ctes() + O.monthly_ctes("", AS_OF)
    assert_same(monthly_events(models["ev"], CFG), fduck.sql(O.with_(ctes, "SELECT * FROM monthly")))


@pytest.mark.parametrize("start", [None, "2024-03-06"])
def test_daily_sweep_matches_oracle(spark, fduck, start):
    cfg = CFG.with_(date_range_start=start)
    stg = stage_events(raw_fixture(spark), cfg)
    ev, first = dedupe_events(stg, cfg), user_first_events(stg)
    sweep = daily_ops.daily_events(ev, first, cfg)
    ctes = (O.stg_ctes("", "SELECT * FROM fixture_raw", PRESENT, None) + O.ev_ctes("", AS_OF, start)
            + O.first_cte("") + O.spine_ctes("", AS_OF, start=start) + O.daily_ctes("", AS_OF))
    assert_same(sweep, fduck.sql(O.with_(ctes, "SELECT * FROM daily")))


def test_daily_golden(models):
    d = daily_ops.daily_events(models["ev"], models["first"], CFG)
    assert d.agg({"date_day": "max"}).first()[0] == AS_OF + dt.timedelta(days=6)   # future event ignored
    v = d.where("source_relation = 'conn_a' and event_type = 'view' and date_day = date'2024-03-05'").first()
    assert v["number_of_users"] == 1 and v["number_of_new_users"] == 1 and v["number_of_events"] == 1
    nulls = d.where("event_type = 'view' and date_day = date'2024-03-06'").first()
    assert nulls["number_of_users"] == 0 and nulls["trailing_users_7d"] == 1


def test_funnel_golden(models):
    f = analyze_funnel(models["ev"], ["PLAY", "view", "click"]).collect()
    assert [(r["event_type"], r["number_of_events"]) for r in f] == [("click", 6), ("view", 6), ("play", 5)]
    top = f[0]
    assert top["relative_event_pct_conversion"] == 1.0 and top["overall_event_pct_conversion"] == 1.0
    assert f[1]["relative_event_pct_conversion"] == pytest.approx(f[1]["number_of_events"] / top["number_of_events"])


def test_funnel_zero_users_gives_null(spark, models):
    only_anon = models["ev"].where("people_id is null")
    f = analyze_funnel(only_anon, ["view"]).first()
    assert f["number_of_users"] == 0 and f["overall_user_pct_conversion"] is None


def test_event_frequency_map(models):
    s = sessions(models["ev"], CFG.with_(event_frequency_map=True))
    p3 = s.where("people_id = 'p3'").first()
    assert p3["event_frequency_map"] == {"click": 1, "view": 1}


def test_true_new_users_uses_all_time_first_event(spark):
    cfg = CFG.with_(date_range_start="2024-05-01", true_new_users=True)
    stg = stage_events(raw_fixture(spark), cfg)
    ev, first = dedupe_events(stg, cfg), user_first_events(stg)
    cut = monthly_events(ev, cfg.with_(true_new_users=False))
    true = monthly_events(ev, cfg, first)
    q = "event_type = 'buy' and date_month = date'2024-05-01'"
    assert cut.where(q).first()["number_of_new_users"] == 1   # first month of the cut table
    assert true.where(q).first()["number_of_new_users"] == 0  # p6 first bought in March


def test_descriptions_persist(spark, tmp_path):
    from eventlens.plans.docs import register_views, with_descriptions

    df = with_descriptions(spark.createDataFrame([(1, 2)], "number_of_users long, x long"), "daily_events")
    df.write.parquet(str(tmp_path / "d"))
    back = spark.read.parquet(str(tmp_path / "d"))
    assert "first event" not in back.schema["number_of_users"].metadata.get("comment", "")
    assert back.schema["number_of_users"].metadata["comment"].startswith("Persons with at least one")
    assert register_views(spark, {"d": back}, prefix="t_") == ["t_d"]
    assert spark.sql("select count(*) c from t_d").first()["c"] == 1


def test_funnel_expression_segment(models):
    seg = "cast(date_trunc('month', occurred_at) as date)"
    f = analyze_funnel(models["ev"], ["view", "buy"], group_by_column=seg)
    assert seg in f.columns
    may = {r["event_type"]: r["number_of_events"] for r in f.collect() if r[seg] == dt.date(2024, 5, 1)}
    assert may == {"view": 1, "buy": 1}


def test_build_with_session_filter_on_other_columns(spark):
    from eventlens.plans.pipeline import build

    cfg = CFG.with_(session_filter="insert_id is not null and loader_row_id != 'f11'")
    m = build(raw_fixture(spark), cfg)
    direct = sessions(dedupe_events(stage_events(raw_fixture(spark), cfg), cfg), cfg)
    assert_frames_equal(m.sessions, direct)
    assert m.daily.count() > 0 and m.monthly.count() > 0


@pytest.mark.parametrize("start", [None, "2024-03-06"])
def test_daily_from_staged_equals_two_input_form(spark, start):
    cfg = CFG.with_(date_range_start=start)
    stg = stage_events(raw_fixture(spark), cfg)
    two = daily_ops.daily_events(dedupe_events(stg, cfg), user_first_events(stg), cfg)
    assert_frames_equal(daily_ops.daily_events_from_staged(stg, cfg), two)


@pytest.mark.parametrize("start", [None, "1999-06-01"])
def test_daily_from_staged_respects_safety_bound(spark, start):
    from eventlens.sources import testdata as td
    from tests.conftest import SF_SMALL

    cfg = Config(source_name="test.orders", as_of_date="2001-08-01", date_range_start=start)
    stg = stage_events(td.raw_from_orders(spark, SF_SMALL), cfg)
    two = daily_ops.daily_events(dedupe_events(stg, cfg), user_first_events(stg), cfg)
    assert_frames_equal(daily_ops.daily_events_from_staged(stg, cfg), two)


def test_churn_modes(models):
    q = "event_type = 'buy' and date_month = date'2024-05-01'"
    row = monthly_events(models["ev"], CFG).where(q).first()
    cal = monthly_events(models["ev"], CFG.with_(churn_mode="previous_month")).where(q).first()
    assert row["number_of_churn_users"] == 1   # compares with March, the previous existing row
    assert cal["number_of_churn_users"] == 0   # April had no buyers
