"""Randomised data with a hot key: one anonymous actor (no person, no device,
no insert id) holds a third of all rows, and gaps cluster around the session
timeout.  Every model must equal the independent SQL."""

import datetime as dt

import duckdb
import numpy as np
import pytest

from eventlens.config import Config
from eventlens.operators import daily as daily_ops
from eventlens.operators.dedupe import dedupe_events
from eventlens.operators.funnel import analyze_funnel
from eventlens.operators.monthly import monthly_events
from eventlens.operators.sessions import sessionized_events, sessions
from eventlens.operators.staging import stage_events, user_first_events
from eventlens.plans import oracle as O
from tests.fixtures import PRESENT, SCHEMA
from tests.helpers import assert_same

AS_OF = dt.date(2024, 3, 20)
CFG = Config(as_of_date=AS_OF)


def random_rows(seed: int, n: int = 3000):
    rng = np.random.default_rng(seed)
    rows = []
    t0 = dt.datetime(2024, 1, 1)
    for i in range(n):
        hot = i % 3 == 0
        person = None if hot else f"p{rng.integers(0, 40)}"
        # bursts: steps of 0-40 minutes plus random seconds, so many gaps sit near 30 boundaries
        base = t0 + dt.timedelta(days=int(rng.integers(0, 80)), hours=int(rng.integers(0, 24)))
        when = base + dt.timedelta(minutes=int(rng.integers(0, 3)) * 29 + int(rng.integers(0, 3)),
                                   seconds=int(rng.integers(0, 60)))
        insert = None if hot and rng.random() < 0.5 else f"i{rng.integers(0, n // 2)}"
        proc = None if rng.random() < 0.05 else int(rng.integers(0, 100))
        device = f"d{rng.integers(0, 5)}" if not hot and rng.random() < 0.2 else None
        name = ["View", "click", "buy", "Signup", None][int(rng.integers(0, 5))] if rng.random() < 0.9 else None
        src = "conn_a" if rng.random() < 0.7 else "conn_b"
        rows.append((src, name, when, person, insert, proc, f"f{i}", device, None))
    return rows


@pytest.fixture(scope="module", params=[7, 11])
def data(request, spark, tmp_path_factory):
    raw = spark.createDataFrame(random_rows(request.param), SCHEMA)
    path = str(tmp_path_factory.mktemp(f"rand{request.param}") / "raw.parquet")
    raw.write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW fixture_raw AS SELECT * FROM read_parquet('{path}/*.parquet')")
    stg = stage_events(spark.read.parquet(path), CFG)
    return stg, con


def ctes():
    return O.stg_ctes("", "SELECT * FROM fixture_raw", PRESENT, None) + O.ev_ctes("", AS_OF)


def test_random_event_table(data):
    stg, con = data
    assert_same(dedupe_events(stg, CFG), con.sql(O.with_(ctes(), "SELECT * FROM ev")))


def test_random_daily(data):
    stg, con = data
    got = daily_ops.daily_events(dedupe_events(stg, CFG, columns=daily_ops.EVENT_COLUMNS), user_first_events(stg), CFG)
    q = ctes() + O.first_cte("") + O.spine_ctes("", AS_OF) + O.daily_ctes("", AS_OF)
    assert_same(got, con.sql(O.with_(q, "SELECT * FROM daily")))


def test_random_daily_single_scan(data):
    stg, con = data
    q = ctes() + O.first_cte("") + O.spine_ctes("", AS_OF) + O.daily_ctes("", AS_OF)
    assert_same(daily_ops.daily_events_from_staged(stg, CFG), con.sql(O.with_(q, "SELECT * FROM daily")))


def test_random_monthly(data):
    stg, con = data
    assert_same(monthly_events(dedupe_events(stg, CFG), CFG),
                con.sql(O.with_(ctes() + O.monthly_ctes("", AS_OF), "SELECT * FROM monthly")))


@pytest.mark.parametrize("timeout", [30, 59])
def test_random_sessions(data, timeout):
    stg, con = data
    cfg = CFG.with_(session_timeout_minutes=timeout)
    ev = dedupe_events(stg, cfg)
    q = ctes() + O.session_ctes("", AS_OF, timeout=timeout)
    assert_same(sessions(ev, cfg), con.sql(O.with_(q, "SELECT * FROM sessions")))
    per_event = sessionized_events(ev, cfg).select("unique_event_id", "previous_event_at", "is_new_session",
                                                   "session_number", "session_id", "number_of_this_event_type")
    assert_same(per_event, con.sql(O.with_(q, "SELECT unique_event_id, previous_event_at, is_new_session, "
                                              "CAST(session_number AS BIGINT) AS session_number, session_id, "
                                              "number_of_this_event_type FROM session_ids")))


def test_random_funnel_segmented(data):
    stg, con = data
    ev = dedupe_events(stg, CFG)
    got = analyze_funnel(ev, ["view", "click", "buy"], group_by_column="source_relation")
    assert_same(got, con.sql(O.funnel_sql(ctes(), "ev", ["view", "click", "buy"], seg="source_relation")))
