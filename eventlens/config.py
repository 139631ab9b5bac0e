"""Run configuration: one frozen dataclass instead of project variables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

from pyspark.sql import Column


@dataclass(frozen=True)
class CustomColumn:
    """A raw column passed through to the staged table.

    ``transform_sql`` is a Spark SQL expression over the raw columns
    (e.g. ``"cast(value as decimal(10,2))"``); ``alias`` renames it.
    """

    name: str
    alias: str | None = None
    transform_sql: str | None = None

    @property
    def output_name(self) -> str:
        return self.alias or self.name


@dataclass(frozen=True)
class PivotProperty:
    """A JSON property of ``event_properties`` pivoted into its own column.

    ``name`` is case sensitive and may hold spaces or dots.
    """

    name: str
    alias: str | None = None

    @property
    def output_name(self) -> str:
        if self.alias:
            return self.alias
        return self.name.replace(" ", "_").replace(".", "_").lower()


def _as_date(value) -> dt.date | None:
    if value is None or isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.datetime):
        return value.date()
    return dt.date.fromisoformat(str(value)[:10])


@dataclass(frozen=True)
class Config:
    # provenance tag used when a single raw table is read (S3)
    source_name: str = "default.event"
    preserve_source_case: bool = False
    # catalogue name -> name in this loader's raw table, where they differ
    raw_names: dict[str, str] = field(default_factory=dict)
    custom_columns: tuple[CustomColumn, ...] = ()
    properties_to_pivot: tuple[PivotProperty | str, ...] = ()
    # "json" looks each property up in the text; "variant" parses the text once,
    # which pays from a handful of properties on
    pivot_method: str = "json"
    # filters given as Spark SQL text or Column
    event_filter: str | Column | None = None
    session_filter: str | Column | None = None
    # None: no lower bound; the spine starts at the earliest first event
    date_range_start: dt.date | str | None = None
    session_timeout_minutes: int = 30
    session_passthrough: tuple[str, ...] = ()
    # also return event counts per type as a map<string, bigint> column
    event_frequency_map: bool = False
    lookback_days: int = 7
    # explicit "today" for determinism
    as_of_date: dt.date | str = field(default_factory=dt.date.today)
    # last spine day is as_of + spine_horizon_days (a one-week exclusive end)
    spine_horizon_days: int = 6
    # monthly new users from the all-time first event instead of the cut table
    true_new_users: bool = False
    # churn against the previous existing row ("previous_row")
    # or against the calendar's previous month, 0 when it had no row
    churn_mode: str = "previous_row"

    def __post_init__(self):
        object.__setattr__(self, "as_of_date", _as_date(self.as_of_date))
        object.__setattr__(self, "date_range_start", _as_date(self.date_range_start))
        object.__setattr__(self, "custom_columns", tuple(
            c if isinstance(c, CustomColumn) else CustomColumn(**c) if isinstance(c, dict) else CustomColumn(c)
            for c in self.custom_columns))
        object.__setattr__(self, "properties_to_pivot", tuple(
            p if isinstance(p, PivotProperty) else PivotProperty(**p) if isinstance(p, dict) else PivotProperty(p)
            for p in self.properties_to_pivot))
        object.__setattr__(self, "session_passthrough", tuple(self.session_passthrough))
        if self.session_timeout_minutes < 0 or self.lookback_days < 0 or self.spine_horizon_days < 0:
            raise ValueError("session_timeout_minutes, lookback_days and spine_horizon_days must be >= 0")
        if self.pivot_method not in ("json", "variant"):
            raise ValueError("pivot_method must be 'json' or 'variant'")
        if self.churn_mode not in ("previous_row", "previous_month"):
            raise ValueError("churn_mode must be 'previous_row' or 'previous_month'")

    @property
    def spine_end(self) -> dt.date:
        return self.as_of_date + dt.timedelta(days=self.spine_horizon_days)

    def with_(self, **changes) -> "Config":
        return replace(self, **changes)
