"""Oracle SQL (DuckDB dialect) for every registered query.

Each statement says what a metric *is*, with self-joins over plain sets of
days, months and minutes, where the Spark plans use sweeps and windows:

* an event table row is the first of its group (``DISTINCT ON``);
* a person counts as trailing user of a day if any of its active days lies in
  the range of days that ends there (range self-join);
* a month's repeat, return and new users are persons with or without activity
  in the month before, in any earlier month, in none (self-join on the month);
* a minute starts a session if no active minute lies in the timeout before it
  (gaps and islands over minutes), an event's session is the number of such
  minutes up to it;
* funnel steps are ranked and joined with the rank before.

Tables ``events`` and ``orders`` are the driver's views.
"""

from __future__ import annotations

from pyspark.sql import types as T

from eventlens.plans import catalog as C
from eventlens.sources import testdata as td
from eventlens.schema import EVENT_COLUMNS, SURROGATE_NULL

_DUCK = {
    T.StringType: "VARCHAR", T.TimestampType: "TIMESTAMP", T.TimestampNTZType: "TIMESTAMP",
    T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.BooleanType: "BOOLEAN",
}

RAW_EVENTS = (
    "SELECT event_type AS name, ts AS \"time\", CAST(user_id AS VARCHAR) AS distinct_id, "
    "CAST(event_id AS VARCHAR) AS insert_id, CAST(event_id AS VARCHAR) AS loader_row_id, "
    "event_id AS mp_processing_time_ms, props AS properties, "
    "CASE WHEN event_id % 3 = 0 THEN 'd' || CAST(user_id AS VARCHAR) END AS device_id, "
    "ts AS loaded_at, event_id, value FROM events")
RAW_EVENTS_COLS = {"name", "time", "distinct_id", "insert_id", "loader_row_id", "mp_processing_time_ms",
                   "properties", "device_id", "loaded_at"}
RAW_REDELIVERED = (
    f"SELECT * FROM ({RAW_EVENTS}) UNION ALL "
    f"SELECT * REPLACE (mp_processing_time_ms + 1000000000000 AS mp_processing_time_ms, "
    f"loader_row_id || '-r' AS loader_row_id) FROM ({RAW_EVENTS})")
RAW_TWO_SOURCES = (
    f"SELECT *, CASE WHEN event_id % 2 = 0 THEN 'test.events_a' ELSE 'test.events_b' END AS source_relation "
    f"FROM ({RAW_EVENTS})")
RAW_ORDERS = (
    "SELECT o_orderpriority AS name, o_orderdate AS \"time\", CAST(o_custkey AS VARCHAR) AS distinct_id, "
    "CAST(o_orderkey AS VARCHAR) AS insert_id, CAST(o_orderkey AS VARCHAR) AS loader_row_id, "
    "o_orderkey AS mp_processing_time_ms FROM orders")
RAW_ORDERS_COLS = {"name", "time", "distinct_id", "insert_id", "loader_row_id", "mp_processing_time_ms"}


def sk(*parts: str) -> str:
    inner = " || '-' || ".join(f"coalesce(CAST({p} AS VARCHAR), '{SURROGATE_NULL}')" for p in parts)
    return f"md5({inner})"


def with_(ctes: list[tuple[str, str]], final: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes) + "\n" + final


# ---- staging / dedupe -------------------------------------------------------

def stg_ctes(p: str, raw: str, present: set[str], source: str | None, where: str | None = None,
             custom: str = "") -> list[tuple[str, str]]:
    cols = []
    for name, dtype, alias in EVENT_COLUMNS:
        expr = f'"{name}"' if name in present else "NULL"
        cols.append(f"CAST({expr} AS {_DUCK[type(dtype)]}) AS {alias or name}")
    rel = f"'{source}'" if source else "lower(source_relation)"
    filt = f"WHERE {where}" if where else ""
    fields = f"SELECT {', '.join(cols)}, {rel} AS source_relation{custom} FROM ({raw}) r {filt}"
    return [(f"{p}fields", fields),
            (f"{p}stg", f"SELECT *, CAST(occurred_at AS DATE) AS date_day, "
                        f"lower(event_type_original_casing) AS event_type FROM {p}fields")]


GROUP = "insert_id, people_id, event_type, date_day, source_relation"


def ev_ctes(p: str, as_of, start=None, pivots: list[str] = ()) -> list[tuple[str, str]]:
    piv = "".join(f", replace(json_extract_string(event_properties, '$.\"{k}\"'), '\"', '') AS {k}" for k in pivots)
    bound = f"occurred_at >= TIMESTAMP '{start}'" if start else "occurred_at IS NOT NULL"
    return [(f"{p}ev",
             f"SELECT DISTINCT ON ({GROUP}) {sk(*GROUP.split(', '))} AS unique_event_id, *, CAST(1 AS BIGINT) AS nth_event_record, "
             f"DATE '{as_of}' AS run_date{piv} FROM {p}stg WHERE {bound} ORDER BY {GROUP}, "
             f"mp_processing_time_ms ASC NULLS LAST, loader_row_id ASC NULLS FIRST, occurred_at ASC NULLS FIRST")]


def events_base(p="", where=None, custom="", as_of=C.EVENTS_AS_OF, start=None, pivots=()):
    return (stg_ctes(p, RAW_EVENTS, RAW_EVENTS_COLS, td.EVENTS_SOURCE, where, custom)
            + ev_ctes(p, as_of, start, pivots))


def orders_base(p=""):
    return (stg_ctes(p, RAW_ORDERS, RAW_ORDERS_COLS, td.ORDERS_SOURCE)
            + ev_ctes(p, C.ORDERS_AS_OF, start=str(C.ORDERS_START)))


def first_cte(p):
    return [(f"{p}first_ev", f"SELECT people_id, source_relation, event_type, min(date_day) AS first_event_day "
                             f"FROM {p}stg GROUP BY 1, 2, 3")]


def same(a: str, b: str, *cols: str) -> str:
    """Null-safe equality of columns of two tables."""
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)


# ---- spine / daily ----------------------------------------------------------

def spine_ctes(p, as_of, horizon=6, start=None):
    last = f"DATE '{as_of}' + INTERVAL {horizon} DAY"
    since = f"greatest(first_event_day, DATE '{start}')" if start else "first_event_day"
    begin = f"DATE '{start}'" if start else f"(SELECT min(first_event_day) FROM {p}first_ev)"
    return [
        (f"{p}spine_days", f"SELECT CAST(unnest(generate_series({begin}, {last}, INTERVAL 1 DAY)) AS DATE) AS date_day"),
        (f"{p}spine",
         f"SELECT source_relation, date_day, people_id, event_type, CAST(date_day = first_event_day AS INTEGER) AS is_first_event_day, "
         f"{sk('people_id', 'date_day', 'event_type', 'source_relation')} AS unique_key FROM ("
         f"SELECT *, CAST(unnest(generate_series({since}, {last}, INTERVAL 1 DAY)) AS DATE) AS date_day FROM {p}first_ev)"),
    ]


def daily_ctes(p, as_of, horizon=6):
    """``active``: days on which a known person did a known type of event;
    ``reach``: each calendar day with the active days of the 28 that end there."""
    return [
        (f"{p}agg_user", f"SELECT source_relation, date_day, people_id, event_type, count(*) AS number_of_events FROM {p}ev GROUP BY ALL"),
        (f"{p}active", f"SELECT a.*, f.first_event_day FROM {p}agg_user a JOIN {p}first_ev f USING (source_relation, people_id, event_type)"),
        (f"{p}calendar", f"SELECT DISTINCT source_relation, event_type, date_day FROM {p}spine"),
        (f"{p}reach", f"SELECT c.*, a.people_id, a.date_day AS active_day, a.number_of_events AS n, a.first_event_day FROM {p}calendar c "
                      f"LEFT JOIN {p}active a ON a.source_relation = c.source_relation AND a.event_type = c.event_type "
                      f"AND a.date_day BETWEEN c.date_day - 27 AND c.date_day"),
        (f"{p}persons", f"SELECT source_relation, event_type, date_day, people_id, max(active_day) AS last_day, "
                        f"coalesce(sum(n) FILTER (active_day = date_day), 0) AS n, count(*) FILTER (active_day < date_day) AS earlier, "
                        f"min(first_event_day) AS first_event_day FROM {p}reach GROUP BY 1, 2, 3, 4"),
        (f"{p}counted",
         f"SELECT source_relation, event_type, date_day, CAST(sum(n) AS BIGINT) AS number_of_events, "
         f"count(people_id) FILTER (n > 0) AS number_of_users, "
         f"count(people_id) FILTER (n > 0 AND first_event_day = date_day) AS number_of_new_users, "
         f"count(people_id) FILTER (n > 0 AND earlier > 0) AS number_of_repeat_users, "
         f"count(people_id) AS trailing_users_28d, count(people_id) FILTER (last_day > date_day - 7) AS trailing_users_7d "
         f"FROM {p}persons GROUP BY 1, 2, 3"),
        (f"{p}daily",
         f"SELECT *, number_of_users - number_of_new_users - number_of_repeat_users AS number_of_return_users, "
         f"event_type || '-' || date_day || '-' || source_relation AS unique_key, DATE '{as_of}' AS run_date FROM {p}counted"),
    ]


def person_day_sql(base, final):
    """Flags of every person and calendar day: the active days of the 28 that end there."""
    return with_(base + [("flags",
        "SELECT s.source_relation, s.date_day, s.people_id, s.event_type, s.is_first_event_day, "
        "coalesce(max(a.number_of_events) FILTER (a.date_day = s.date_day), 0) AS number_of_events, "
        "count(a.date_day) > 0 AS has_event_in_last_28_days, "
        "count(a.date_day) FILTER (a.date_day > s.date_day - 7) > 0 AS has_event_in_last_7_days, "
        "count(a.date_day) FILTER (a.date_day < s.date_day) > 0 AND count(a.date_day) FILTER (a.date_day = s.date_day) > 0 AS is_repeat_user "
        "FROM spine s LEFT JOIN active a ON a.source_relation = s.source_relation AND a.people_id = s.people_id "
        "AND a.event_type = s.event_type AND a.date_day BETWEEN s.date_day - 27 AND s.date_day GROUP BY 1, 2, 3, 4, 5")], final)


def daily_full(p, base, as_of, start=None):
    return base + first_cte(p) + spine_ctes(p, as_of, start=start) + daily_ctes(p, as_of)


# ---- monthly ----------------------------------------------------------------

def monthly_ctes(p, as_of, true_first=False):
    """``pm``: a person's months of activity with a type; the month before and
    the first month come from self-joins."""
    who = ("source_relation", "people_id", "event_type")
    debut = (f"SELECT source_relation, people_id, event_type, CAST(date_trunc('month', first_event_day) AS DATE) AS debut FROM {p}first_ev"
             if true_first else f"SELECT source_relation, people_id, event_type, min(date_month) AS debut FROM {p}pm GROUP BY ALL")
    return [
        (f"{p}pm", f"SELECT source_relation, people_id, event_type, CAST(date_trunc('month', occurred_at) AS DATE) AS date_month, "
                   f"count(*) AS number_of_events FROM {p}ev GROUP BY ALL"),
        (f"{p}month_totals", f"SELECT source_relation, date_month, count(DISTINCT people_id) AS total_monthly_active_users FROM {p}pm GROUP BY ALL"),
        (f"{p}debuts", debut),
        (f"{p}history", f"SELECT m.*, d.debut AS first_month, max(e.date_month) AS previous_month_with_event FROM {p}pm m "
                        f"LEFT JOIN {p}debuts d ON {same('m', 'd', *who)} "
                        f"LEFT JOIN {p}pm e ON {same('m', 'e', *who)} AND e.date_month < m.date_month GROUP BY ALL"),
        (f"{p}by_type",
         f"SELECT h.source_relation, h.date_month, h.event_type, t.total_monthly_active_users, "
         f"count(h.people_id) AS number_of_users, count(h.people_id) FILTER (h.first_month = h.date_month) AS number_of_new_users, "
         f"count(h.people_id) FILTER (h.previous_month_with_event = h.date_month - INTERVAL 1 MONTH) AS number_of_repeat_users, "
         f"count(h.people_id) FILTER (h.previous_month_with_event < h.date_month - INTERVAL 1 MONTH) AS number_of_return_users, "
         f"CAST(sum(h.number_of_events) AS BIGINT) AS number_of_events FROM {p}history h "
         f"JOIN {p}month_totals t ON t.source_relation = h.source_relation AND t.date_month = h.date_month GROUP BY 1, 2, 3, 4"),
        (f"{p}monthly",
         f"SELECT b.*, coalesce((SELECT arg_max(x.number_of_users, x.date_month) FROM {p}by_type x "
         f"WHERE {same('x', 'b', 'source_relation', 'event_type')} AND x.date_month < b.date_month) - b.number_of_repeat_users, 0) AS number_of_churn_users, "
         f"b.date_month || '-' || b.event_type || '-' || b.source_relation AS unique_key, DATE '{as_of}' AS run_date FROM {p}by_type b"),
    ]


# ---- sessions ---------------------------------------------------------------

def session_ctes(p, as_of, timeout=30, criteria=None, passthrough=()):
    """Gaps and islands over the minutes in which an actor was active on a day."""
    actor = ("source_relation", "user_id", "date_day")
    extra = "".join(f", {c}" for c in passthrough)
    where = f"WHERE {criteria}" if criteria else ""
    row = "{" + ", ".join(f"'{c}': {c}" for c in ("occurred_at", "unique_event_id", "people_id", "device_id", *passthrough)) + "}"
    return [
        (f"{p}acts", f"SELECT source_relation, event_type, occurred_at, unique_event_id, people_id, date_day, device_id, "
                     f"coalesce(device_id, people_id) AS user_id, date_trunc('minute', occurred_at) AS minute{extra} FROM {p}ev {where}"),
        (f"{p}minutes", f"SELECT DISTINCT source_relation, user_id, date_day, minute FROM {p}acts"),
        (f"{p}starts", f"SELECT m.* FROM {p}minutes m LEFT JOIN {p}minutes q ON {same('q', 'm', *actor)} AND q.minute < m.minute "
                       f"AND q.minute >= m.minute - INTERVAL {timeout} MINUTE WHERE q.minute IS NULL"),
        (f"{p}islands", f"SELECT m.*, count(s.minute) AS session_number, max(s.minute) AS start_minute FROM {p}minutes m "
                        f"JOIN {p}starts s ON {same('s', 'm', *actor)} AND s.minute <= m.minute GROUP BY ALL"),
        (f"{p}placed", f"SELECT a.*, i.session_number, i.start_minute FROM {p}acts a JOIN {p}islands i ON {same('i', 'a', *actor, 'minute')}"),
        (f"{p}bounds", f"SELECT source_relation, user_id, date_day, session_number, count(*) AS total_number_of_events, "
                       f"min({row}) AS opening FROM {p}placed GROUP BY 1, 2, 3, 4"),
        (f"{p}kinds", f"SELECT source_relation, user_id, date_day, session_number, event_type, count(*) AS number_of_this_event_type "
                      f"FROM {p}placed GROUP BY ALL"),
        (f"{p}rendered", f"SELECT source_relation, user_id, date_day, session_number, "
                         f"'{{' || string_agg(event_type || ': ' || number_of_this_event_type, ', ' ORDER BY event_type) || '}}' AS event_frequencies "
                         f"FROM {p}kinds GROUP BY 1, 2, 3, 4"),
        (f"{p}session_ids",
         f"SELECT e.unique_event_id, e.user_id, e.occurred_at, "
         f"max(e.occurred_at) OVER (PARTITION BY e.source_relation, e.user_id, e.date_day ORDER BY e.occurred_at, e.unique_event_id "
         f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_event_at, "
         f"CAST(e.unique_event_id = b.opening.unique_event_id AS INTEGER) AS is_new_session, e.session_number, "
         f"{sk('e.user_id', 'e.session_number', 'e.date_day', 'e.source_relation')} AS session_id, "
         f"b.opening.occurred_at AS session_started_at, k.number_of_this_event_type, b.total_number_of_events "
         f"FROM {p}placed e JOIN {p}bounds b ON {same('b', 'e', *actor, 'session_number')} "
         f"JOIN {p}kinds k ON {same('k', 'e', *actor, 'session_number', 'event_type')}"),
        (f"{p}sessions",
         f"SELECT b.source_relation, {sk('b.user_id', 'b.session_number', 'b.date_day', 'b.source_relation')} AS session_id, "
         f"b.opening.people_id AS people_id, b.opening.occurred_at AS session_started_at, b.date_day AS session_started_on_day, "
         f"b.user_id, b.opening.device_id AS device_id, b.total_number_of_events, r.event_frequencies, DATE '{as_of}' AS run_date"
         + "".join(f", b.opening.{c} AS {c}" for c in passthrough)
         + f" FROM {p}bounds b JOIN {p}rendered r ON {same('r', 'b', *actor, 'session_number')}"),
    ]


# ---- funnel -----------------------------------------------------------------

def funnel_sql(ctes, ev, steps, seg=None, criteria=None):
    """Steps in order of their volume; each is held against the first and the one before."""
    segment = seg or "'all'"
    wanted = ", ".join(f"'{s.lower()}'" for s in steps)
    ranked = ", ".join(f"row_number() OVER (PARTITION BY segment ORDER BY {n} DESC, event_type) AS {r}" for n, r in (("number_of_events", "er"), ("number_of_users", "ur")))

    def ratio(n, r, at):
        other = f"(SELECT o.{n} FROM ranked o WHERE o.segment = s.segment AND o.{r} = {at})"
        return f"CAST(s.{n} AS DOUBLE) / nullif({other}, 0)"

    def relative(n, r):
        return f"CASE WHEN s.{r} = 1 THEN 1 ELSE coalesce({ratio(n, r, f's.{r} - 1')}, 0) END"

    ctes = ctes + [
        ("step_counts", f"SELECT {segment} AS segment, event_type, count(*) AS number_of_events, count(DISTINCT people_id) AS number_of_users "
                        f"FROM {ev} WHERE lower(event_type) IN ({wanted}) AND ({criteria or 'true'}) GROUP BY 1, 2"),
        ("ranked", f"SELECT *, {ranked} FROM step_counts"),
    ]
    first = f"segment AS {seg}, " if seg else ""
    return with_(ctes, (
        f"SELECT {first}event_type, number_of_events, number_of_users, "
        f"{ratio('number_of_events', 'er', 1)} AS overall_event_pct_conversion, {ratio('number_of_users', 'ur', 1)} AS overall_user_pct_conversion, "
        f"{relative('number_of_events', 'er')} AS relative_event_pct_conversion, {relative('number_of_users', 'ur')} AS relative_user_pct_conversion "
        f"FROM ranked s"))


# ---- the registry -------------------------------------------------------------

def _sessions_base(**kw):
    return events_base() + session_ctes("", C.EVENTS_AS_OF, **kw)


def _key_model_ctes():
    return (events_base() + first_cte("") + spine_ctes("", C.EVENTS_AS_OF) + daily_ctes("", C.EVENTS_AS_OF)
            + session_ctes("", C.EVENTS_AS_OF) + orders_base("o_") + monthly_ctes("o_", C.ORDERS_AS_OF))


_KEY_MODELS = [("event", "ev", "unique_event_id"), ("daily_events", "daily", "unique_key"),
               ("monthly_events", "o_monthly", "unique_key"), ("sessions", "sessions", "session_id"),
               ("user_event_date_spine", "spine", "unique_key")]


def _prod_dev_ctes():
    out = []
    for p, where in (("p_", None), ("d_", C.DEV_FILTER)):
        out += stg_ctes(p, RAW_EVENTS, RAW_EVENTS_COLS, td.EVENTS_SOURCE, where) + ev_ctes(p, C.EVENTS_AS_OF)
        out += first_cte(p) + spine_ctes(p, C.EVENTS_AS_OF) + daily_ctes(p, C.EVENTS_AS_OF)
        out += monthly_ctes(p, C.EVENTS_AS_OF) + session_ctes(p, C.EVENTS_AS_OF)
    return out


def oracle_queries() -> dict[str, str]:
    as_of = C.EVENTS_AS_OF
    q: dict[str, str] = {}
    q["stage_events"] = with_(stg_ctes("", RAW_EVENTS, RAW_EVENTS_COLS, td.EVENTS_SOURCE), "SELECT * FROM stg")
    q["custom_columns"] = with_(
        stg_ctes("", RAW_EVENTS, RAW_EVENTS_COLS, td.EVENTS_SOURCE,
                 custom=", CAST(value AS DECIMAL(10,2)) AS event_value, event_id"),
        "SELECT loader_row_id, event_id, event_value, event_type, date_day FROM stg")
    q["pivot_properties"] = with_(events_base(pivots=["k"]), "SELECT unique_event_id, event_properties, k FROM ev")
    q["union_sources"] = with_(
        stg_ctes("", RAW_TWO_SOURCES, RAW_EVENTS_COLS, None),
        "SELECT source_relation, loader_row_id, people_id, event_type, occurred_at, date_day FROM stg")
    q["global_filter"] = with_(
        stg_ctes("", RAW_EVENTS, RAW_EVENTS_COLS, td.EVENTS_SOURCE, "name != 'error' and distinct_id is not null"),
        "SELECT loader_row_id, people_id, event_type, date_day FROM stg")
    q["date_range_filter"] = with_(events_base(start="2024-01-10"),
                                   "SELECT unique_event_id, occurred_at, date_day FROM ev")
    q["surrogate_key"] = with_(
        stg_ctes("", RAW_EVENTS, RAW_EVENTS_COLS, td.EVENTS_SOURCE),
        f"SELECT loader_row_id, {sk('insert_id', 'people_id', 'event_type', 'date_day', 'source_relation')} "
        f"AS unique_event_id, {sk('device_id', 'date_day')} AS device_day_key FROM stg")
    q["dedupe_events"] = with_(stg_ctes("", RAW_REDELIVERED, RAW_EVENTS_COLS, td.EVENTS_SOURCE)
                               + ev_ctes("", as_of), "SELECT * FROM ev")
    q["user_first_event"] = with_(stg_ctes("", RAW_EVENTS, RAW_EVENTS_COLS, td.EVENTS_SOURCE) + first_cte(""),
                                  "SELECT * FROM first_ev")
    spine = events_base() + first_cte("") + spine_ctes("", as_of)
    q["date_spine_sequence"] = with_(spine, "SELECT date_day FROM spine_days")
    q["user_event_spine"] = with_(spine, "SELECT * FROM spine")
    daily = daily_full("", events_base(), as_of)
    q["daily_user_counts"] = with_(daily, "SELECT * FROM agg_user")
    q["spine_left_join"] = person_day_sql(daily, "SELECT source_relation, date_day, people_id, event_type, is_first_event_day, "
                                          "number_of_events FROM flags")
    q["trailing_28d_7d"] = person_day_sql(daily, "SELECT source_relation, date_day, people_id, event_type, "
                                          "has_event_in_last_28_days, has_event_in_last_7_days FROM flags")
    q["repeat_users"] = person_day_sql(daily, "SELECT source_relation, date_day, people_id, event_type, number_of_events, "
                                       "is_repeat_user FROM flags")
    q["daily_events"] = with_(daily, "SELECT * FROM daily")
    q["daily_events_sweep"] = with_(daily_full("", orders_base(), C.ORDERS_AS_OF, start=C.ORDERS_START), "SELECT * FROM daily")
    missing = f"SELECT *, 'test.events_a' AS source_relation FROM ({RAW_EVENTS}) WHERE event_id % 2 = 0 UNION ALL "
    missing += f"SELECT * REPLACE (CAST(NULL AS VARCHAR) AS properties), 'test.events_b' FROM ({RAW_EVENTS}) WHERE event_id % 2 = 1"
    q["union_missing_columns"] = with_(stg_ctes("", missing, RAW_EVENTS_COLS, None) + ev_ctes("", as_of), "SELECT * FROM ev")
    q["map_passthrough"] = with_(
        stg_ctes("", RAW_REDELIVERED, RAW_EVENTS_COLS, td.EVENTS_SOURCE) + ev_ctes("", as_of),
        "SELECT unique_event_id, json_extract_string(event_properties, '$.k') AS k FROM ev")
    two = stg_ctes("", RAW_TWO_SOURCES, RAW_EVENTS_COLS, None) + ev_ctes("", as_of)
    q["daily_events_two_sources"] = with_(daily_full("", two, as_of), "SELECT * FROM daily")
    ranged = events_base(start=str(C.RANGE_START)) + first_cte("") + spine_ctes("", as_of, start=C.RANGE_START)
    q["daily_events_date_range"] = with_(ranged + daily_ctes("", as_of), "SELECT * FROM daily")
    q["user_event_spine_date_range"] = with_(ranged, "SELECT * FROM spine")
    q["monthly_true_new_users"] = with_(
        stg_ctes("", RAW_ORDERS, RAW_ORDERS_COLS, td.ORDERS_SOURCE) + ev_ctes("", C.ORDERS_AS_OF, start=str(C.ORDERS_CUT))
        + first_cte("") + monthly_ctes("", C.ORDERS_AS_OF, true_first=True), "SELECT * FROM monthly")
    q["sessions_two_sources"] = with_(two + session_ctes("", as_of), "SELECT * FROM sessions")
    monthly = orders_base() + monthly_ctes("", C.ORDERS_AS_OF)
    q["month_totals_mau"] = with_(monthly, "SELECT * FROM month_totals")
    q["first_month_window"] = with_(monthly, "SELECT source_relation, people_id, event_type, date_month, "
                                             "number_of_events, first_month FROM history")
    q["previous_month_lag"] = with_(monthly, "SELECT source_relation, people_id, event_type, date_month, "
                                             "previous_month_with_event FROM history")
    q["monthly_events"] = with_(monthly, "SELECT * FROM monthly")
    q["churn_lag"] = with_(monthly, "SELECT source_relation, date_month, event_type, number_of_users, "
                                    "number_of_repeat_users, number_of_churn_users FROM monthly")
    sess = _sessions_base()
    q["previous_event_lag"] = with_(sess, "SELECT unique_event_id, user_id, occurred_at, previous_event_at "
                                          "FROM session_ids")
    q["session_numbers"] = with_(sess, "SELECT unique_event_id, is_new_session, "
                                       "CAST(session_number AS BIGINT) AS session_number, session_id FROM session_ids")
    q["session_event_counts"] = with_(sess, "SELECT unique_event_id, session_id, session_started_at, "
                                            "number_of_this_event_type, total_number_of_events FROM session_ids")
    q["event_frequencies"] = with_(_sessions_base(timeout=C.LONG_TIMEOUT),
                                   "SELECT session_id, total_number_of_events, event_frequencies FROM sessions")
    q["sessions"] = with_(sess, "SELECT * FROM sessions")
    q["sessions_passthrough"] = with_(
        _sessions_base(criteria="event_type != 'error'", passthrough=("insert_id", "event_properties")),
        "SELECT * FROM sessions")
    q["recent_users_semi_join"] = with_(
        events_base() + [
            ("ue", "SELECT *, coalesce(device_id, people_id) AS user_id FROM ev"),
            ("recent", f"SELECT DISTINCT source_relation, user_id FROM ue "
                       f"WHERE CAST(occurred_at AS DATE) >= DATE '{C.RECENT_SINCE}'")],
        "SELECT unique_event_id, source_relation, user_id, occurred_at FROM ue WHERE EXISTS (SELECT 1 FROM recent r "
        "WHERE r.source_relation IS NOT DISTINCT FROM ue.source_relation AND r.user_id IS NOT DISTINCT FROM ue.user_id)")
    q["funnel"] = funnel_sql(events_base(), "ev", C.FUNNEL_STEPS)
    q["funnel_segmented"] = funnel_sql(
        stg_ctes("", RAW_TWO_SOURCES, RAW_EVENTS_COLS, None) + ev_ctes("", as_of), "ev",
        ["VIEW", "Click", "purchase", "signup"], seg="source_relation")
    q["funnel_criteria"] = funnel_sql(events_base(), "ev", C.FUNNEL_STEPS,
                                      criteria="device_id is not null and date_day >= date '2024-01-15'")
    keys = _key_model_ctes()
    q["unique_check"] = with_(keys, " UNION ALL ".join(
        f"SELECT '{m}' AS model, '{k}' AS column_name, 'unique' AS test, count(*) AS failures FROM "
        f"(SELECT {k} FROM {t} WHERE {k} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)" for m, t, k in _KEY_MODELS))
    q["not_null_check"] = with_(keys, " UNION ALL ".join(
        f"SELECT '{m}' AS model, '{k}' AS column_name, 'not_null' AS test, "
        f"count(*) FILTER (WHERE {k} IS NULL) AS failures FROM {t}" for m, t, k in _KEY_MODELS))
    at = f"TIMESTAMP '{C.FRESHNESS_AT}'"
    hours = f"(epoch_us({at}) - epoch_us(max(loaded_at))) / 3.6e9"
    q["freshness_check"] = with_(
        stg_ctes("", RAW_TWO_SOURCES, RAW_EVENTS_COLS, None),
        f"SELECT source_relation, max(loaded_at) AS max_loaded_at, {at} AS checked_at, "
        f"{hours} AS hours_since_load, CASE WHEN max(loaded_at) IS NULL THEN 'error' "
        f"WHEN {hours} > 96 THEN 'error' WHEN {hours} > 72 THEN 'warn' ELSE 'pass' END AS status "
        f"FROM stg GROUP BY 1")
    pd = _prod_dev_ctes()
    q["row_count_compare"] = with_(pd, "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{m}' AS model, (SELECT count(*) FROM p_{t}) AS prod_rows, (SELECT count(*) FROM d_{t}) AS dev_rows"
        for m, t in (("event", "ev"), ("daily_events", "daily"), ("monthly_events", "monthly"),
                     ("sessions", "sessions"))) + ") WHERE prod_rows != dev_rows")
    q["row_set_compare"] = with_(
        pd, "SELECT *, 'from prod' AS source FROM (SELECT * FROM p_daily EXCEPT SELECT * FROM d_daily) "
            "UNION ALL SELECT *, 'from dev' AS source FROM (SELECT * FROM d_daily EXCEPT SELECT * FROM p_daily)")
    q["lookback_incremental_events"] = with_(
        events_base() + stg_ctes("prev_", f"SELECT * FROM ({RAW_EVENTS}) WHERE loaded_at < "
                                          f"TIMESTAMP '{C.LATE_CUT}'", RAW_EVENTS_COLS, td.EVENTS_SOURCE)
        + ev_ctes("prev_", as_of),
        f"SELECT * FROM ev WHERE date_day >= (SELECT CAST(least(max(date_day), DATE '{as_of}') "
        f"- INTERVAL {C.EVENTS_CFG.lookback_days} DAY AS DATE) FROM prev_ev)")
    q["mau_sketches"] = with_(monthly, "SELECT *, true AS within_bound FROM month_totals")
    q["mau_bitmaps"] = q["month_totals_mau"]
    q["funnel_bitmaps"] = q["funnel_segmented"]
    q["funnel_function"] = q["funnel"]
    q["catalog_event"] = with_(sess, (
        "SELECT * FROM (SELECT date_day, source_relation, count(*) AS number_of_events FROM ev GROUP BY ALL) "
        "JOIN (SELECT session_started_on_day AS date_day, source_relation, count(*) AS number_of_sessions, "
        "CAST(sum(total_number_of_events) AS BIGINT) AS session_events FROM sessions GROUP BY ALL) USING (date_day, source_relation)"))
    q["staged_view"] = q["csv_events"] = q["stage_events"]
    q["source_case"] = (
        f"SELECT CASE WHEN event_id % 2 = 0 THEN 'Test.Events_A' ELSE 'test.Events_B' END AS source_relation, loader_row_id, "
        f"CAST(\"time\" AS DATE) AS date_day FROM ({RAW_EVENTS})")
    q["pivot_variant"] = with_(events_base(), (
        "SELECT unique_event_id, " + ", ".join(f"CAST(CAST(insert_id AS BIGINT) % {i + 1} AS VARCHAR) AS p{i + 1}" for i in range(19))
        + ", 'a b' || insert_id AS text_of_it FROM ev"))
    late_dev = stg_ctes("d_", RAW_EVENTS, RAW_EVENTS_COLS, td.EVENTS_SOURCE, C.LATE_FILTER.replace("timestamp'", "TIMESTAMP '")) + ev_ctes("d_", as_of)
    q["partition_compare"] = with_(
        events_base() + late_dev, "SELECT unique_event_id, date_day, 'from prod' AS source FROM ev WHERE NOT EXISTS "
        "(SELECT 1 FROM d_ev WHERE d_ev.unique_event_id = ev.unique_event_id)")
    some_dev = stg_ctes("d_", RAW_EVENTS, RAW_EVENTS_COLS, td.EVENTS_SOURCE, C.DEV_FILTER) + ev_ctes("d_", as_of)
    q["row_set_compare_except"] = with_(
        events_base() + some_dev, "SELECT unique_event_id, event_type, 'from prod' AS source FROM ev WHERE NOT EXISTS "
        "(SELECT 1 FROM d_ev WHERE d_ev.unique_event_id = ev.unique_event_id)")
    q["streaming_incremental"] = q["daily_events"]
    q["streaming_dedupe"] = q["dedupe_events"]
    q["daily_from_masks"] = with_(daily, f"SELECT * FROM daily WHERE date_day > DATE '{C.STATE_DAY}'")
    q["daily_masks_advanced"] = with_(
        events_base(),
        "SELECT source_relation, people_id, event_type, CAST(sum(1 << d) AS BIGINT) AS mask FROM (SELECT DISTINCT source_relation, people_id, "
        f"event_type, date_diff('day', date_day, DATE '{C.STATE_DAY}') AS d FROM ev WHERE people_id IS NOT NULL AND event_type IS NOT NULL) "
        "WHERE d BETWEEN 0 AND 27 GROUP BY ALL")
    q["monthly_from_state"] = with_(monthly, f"SELECT * FROM monthly WHERE date_month >= DATE '{C.STATE_MONTH}'")
    late = (f"SELECT * REPLACE (CASE WHEN event_id % 50 = 7 THEN greatest(loaded_at, TIMESTAMP '{C.LATE_CUT}') ELSE loaded_at END AS loaded_at) "
            f"FROM ({RAW_EVENTS})")
    stored = stg_ctes("", late, RAW_EVENTS_COLS, td.EVENTS_SOURCE) + ev_ctes("", as_of)
    q["incremental_event"] = q["incremental_delete_insert"] = with_(stored, "SELECT * FROM ev")
    q["incremental_first_events"] = q["user_first_event"]
    q["incremental_daily"] = with_(daily_full("", stored, as_of), "SELECT * FROM daily")
    q["incremental_monthly"] = with_(stored + monthly_ctes("", as_of), "SELECT * FROM monthly")
    q["incremental_sessions"] = with_(stored + session_ctes("", as_of), "SELECT * FROM sessions")
    return q
