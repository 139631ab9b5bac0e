"""Date/time expressions with the cross-warehouse semantics pinned down."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def lit_date(value: dt.date | str) -> Column:
    """A DATE literal (keeps partition pruning: the bound is a constant)."""
    if isinstance(value, str):
        value = dt.date.fromisoformat(value[:10])
    return F.lit(value).cast("date")


def shift_date(value: dt.date, days: int = 0, months: int = 0) -> dt.date:
    """Driver-side date arithmetic for literal bounds: ``value + days`` or
    ``value + months`` (day clamped to the month's length, like ``add_months``)."""
    if months:
        y, m = divmod(value.year * 12 + value.month - 1 + months, 12)
        nxt = dt.date(y + (m + 1) // 12, (m + 1) % 12 + 1, 1)
        last = (nxt - dt.timedelta(days=1)).day
        value = dt.date(y, m + 1, min(value.day, last))
    return value + dt.timedelta(days=days)


def month_diff(start, end) -> Column:
    """Whole months between two month-start dates (exact for month starts)."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    return F.months_between(end, start).cast("int")


def sql_filter(condition) -> Column | None:
    """Accept a SQL snippet or a Column; ``None``/``'true'`` means no filter."""
    if condition is None:
        return None
    if isinstance(condition, str):
        if condition.strip().lower() in ("", "true"):
            return None
        return F.expr(condition)
    return condition
