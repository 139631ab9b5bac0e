"""Hand-built raw event rows covering the edge cases of the semantics.

Each row: (source, name, time, distinct_id, insert_id, mp_processing_time_ms,
loader_row_id, device_id, loaded_at).  Columns not listed here are
missing from the raw table on purpose (they must come out NULL).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

AS_OF = dt.date(2024, 5, 31)
A, B = "conn_a", "conn_b"


def t(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


ROWS = [
    # p1: same insert_id on two days (both kept), exact duplicate (later copy dropped), NULL insert_id pair
    (A, "Play", t("2024-03-01 10:00:00"), "p1", "a1", 10, "f01", None, None),
    (A, "play", t("2024-03-02 10:00:00"), "p1", "a1", 11, "f02", None, None),
    (A, "play", t("2024-03-01 10:05:00"), "p1", "a2", 100, "f03", None, None),
    (A, "play", t("2024-03-01 10:05:00"), "p1", "a2", 200, "f04", None, None),
    (A, "play", t("2024-03-01 11:00:00"), "p1", None, 5, "f05", None, None),
    (A, "play", t("2024-03-01 11:10:00"), "p1", None, 3, "f06", None, None),
    # p2: NULL processing time sorts last
    (A, "view", t("2024-03-05 09:00:00"), "p2", "b1", None, "f07", None, None),
    (A, "view", t("2024-03-05 09:00:00"), "p2", "b1", 50, "f08", None, None),
    # NULL person, with and without device
    (A, "view", t("2024-03-05 12:00:00"), None, "n1", 1, "f09", "dev9", None),
    (A, "view", t("2024-03-06 12:00:00"), None, "n2", 1, "f10", None, None),
    # p3: tie on time
    (A, "click", t("2024-03-07 08:00:00"), "p3", "c1", 1, "f11", None, None),
    (A, "view", t("2024-03-07 08:00:00"), "p3", "c2", 1, "f12", None, None),
    # p4: 30 minute boundaries (30m59s elapsed) stays, 31 boundaries starts a new session
    (A, "click", t("2024-03-08 10:00:00"), "p4", "d1", 1, "f13", None, None),
    (A, "click", t("2024-03-08 10:30:59"), "p4", "d2", 1, "f14", None, None),
    (A, "click", t("2024-03-08 11:01:58"), "p4", "d3", 1, "f15", None, None),
    # p5: pair across midnight
    (A, "click", t("2024-03-09 23:50:00"), "p5", "e1", 1, "f16", None, None),
    (A, "click", t("2024-03-10 00:05:00"), "p5", "e2", 1, "f17", None, None),
    # p6: skipped month
    (A, "buy", t("2024-03-15 12:00:00"), "p6", "g1", 1, "f18", None, None),
    (A, "buy", t("2024-05-15 12:00:00"), "p6", "g2", 1, "f19", None, None),
    # p2: late arrival (synced 10 days later) and a future-dated event
    (A, "view", t("2024-05-25 09:00:00"), "p2", "b2", 1, "f20", None, t("2024-06-04 09:00:00")),
    (A, "view", t("2024-06-30 09:00:00"), "p2", "b3", 1, "f21", None, None),
    # NULL event name
    (A, None, t("2024-03-05 10:00:00"), "p2", "z1", 1, "f23", None, None),
    # a second connection sharing a person id
    (B, "play", t("2024-03-01 10:00:00"), "p1", "a1", 10, "f22", None, None),
]

SCHEMA = T.StructType([
    T.StructField("source_relation", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("distinct_id", T.StringType()),
    T.StructField("insert_id", T.StringType()),
    T.StructField("mp_processing_time_ms", T.LongType()),
    T.StructField("loader_row_id", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
])
PRESENT = {f.name for f in SCHEMA.fields} - {"source_relation"}


def raw_fixture(spark):
    return spark.createDataFrame(ROWS, SCHEMA)
