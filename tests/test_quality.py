"""Data-quality jobs on small crafted inputs."""

import datetime as dt

from eventlens.operators import quality


def test_unique_and_not_null(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert quality.unique_check(df, "k", "m").first()["failures"] == 1
    assert quality.not_null_check(df, "k", "m").first()["failures"] == 2


def test_freshness_grades(spark):
    df = spark.createDataFrame(
        [("s1", dt.datetime(2024, 1, 1, 0)), ("s2", dt.datetime(2023, 12, 29, 0)), ("s3", dt.datetime(2023, 12, 27))],
        "source_relation string, loaded_at timestamp_ntz")
    got = {r["source_relation"]: r["status"] for r in quality.freshness_check(df, dt.datetime(2024, 1, 2)).collect()}
    assert got == {"s1": "pass", "s2": "warn", "s3": "error"}


def test_compare_versions(spark):
    prod = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "a int, b string")
    dev = spark.createDataFrame([(1, "x"), (3, "z")], "a int, b string")
    counts = quality.compare_row_counts(prod, dev, "m").collect()
    assert [(r["prod_rows"], r["dev_rows"]) for r in counts] == [(3, 2)]
    assert quality.compare_row_counts(dev, dev, "m").count() == 0
    diff = {(r["a"], r["source"]) for r in quality.compare_row_sets(prod, dev, exclude=["b"]).collect()}
    assert diff == {(2, "from prod"), (3, "from dev")}
