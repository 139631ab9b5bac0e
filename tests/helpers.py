"""Comparison helpers shared by the tests."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter


def norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def assert_same(spark_df, duck_rel):
    s_cols, s_rows = spark_df.columns, [tuple(r) for r in spark_df.collect()]
    d_cols, d_rows = duck_rel.columns, duck_rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols), (sorted(set(s_cols) ^ set(d_cols)))
    a, b = bag(s_cols, s_rows), bag(d_cols, d_rows)
    if a != b:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        raise AssertionError(f"{len(s_rows)} vs {len(d_rows)} rows; spark-only {only_s}; duck-only {only_d}")


def assert_frames_equal(left, right):
    assert sorted(left.columns) == sorted(right.columns), sorted(set(left.columns) ^ set(right.columns))
    cols = sorted(left.columns)
    a = bag(cols, [tuple(r) for r in left.select(*cols).collect()])
    b = bag(cols, [tuple(r) for r in right.select(*cols).collect()])
    if a != b:
        raise AssertionError(f"left-only {list((a - b).elements())[:3]}; right-only {list((b - a).elements())[:3]}")
