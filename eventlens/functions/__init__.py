"""Column-level helpers; every one returns a built-in Spark expression."""

from eventlens.functions.keys import concat_key, surrogate_key
from eventlens.functions.timeutil import lit_date, month_diff, sql_filter
from eventlens.functions.json_props import json_property_sql

__all__ = [
    "concat_key",
    "json_property_sql",
    "lit_date",
    "month_diff",
    "sql_filter",
    "surrogate_key",
]
