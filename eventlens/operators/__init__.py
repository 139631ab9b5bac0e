"""Dataset operators: each is a DataFrame -> DataFrame function."""

from eventlens.operators.daily import daily_events, daily_user_counts
from eventlens.operators.dedupe import dedupe_events
from eventlens.operators.funnel import analyze_funnel
from eventlens.operators.monthly import month_totals, monthly_events, user_monthly_events
from eventlens.operators.quality import (
    compare_row_counts,
    compare_row_sets,
    freshness_check,
    not_null_check,
    unique_check,
)
from eventlens.operators.sessions import recent_actor_events, sessionized_events, sessions
from eventlens.operators.spine import date_spine, spine_start, user_event_spine
from eventlens.operators.staging import stage_events, user_first_events

__all__ = [
    "analyze_funnel",
    "compare_row_counts",
    "compare_row_sets",
    "daily_events",
    "daily_user_counts",
    "date_spine",
    "dedupe_events",
    "freshness_check",
    "month_totals",
    "monthly_events",
    "not_null_check",
    "recent_actor_events",
    "sessionized_events",
    "sessions",
    "spine_start",
    "stage_events",
    "unique_check",
    "user_event_spine",
    "user_first_events",
    "user_monthly_events",
]
