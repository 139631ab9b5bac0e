"""Partitioned writes: the input is computed once and written once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventlens.config import Config
from eventlens.operators.dedupe import dedupe_events
from eventlens.operators.sessions import sessions
from eventlens.operators.staging import stage_events
from eventlens.sources.sinks import list_files, overwrite_values, overwrite_window, partition_values, write_full
from tests.fixtures import raw_fixture

DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]


def counted(spark, df):
    """``df`` with an accumulator that counts the rows computed."""
    acc = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def seen(x):
        acc.add(1)
        return x

    return df.withColumn("id", seen("id")), acc


def dated(spark, n, days=DAYS):
    day = F.element_at(F.array(*[F.lit(d) for d in days]), (F.col("id") % len(days) + 1).cast("int"))
    return spark.range(n).repartition(4).withColumn("date_day", day)


def held(spark, path):
    return sorted((str(r["date_day"]), r["id"]) for r in spark.read.parquet(path).collect())


def test_a_write_computes_its_input_once(spark, tmp_path):
    df, acc = counted(spark, dated(spark, 600))
    write_full(df, str(tmp_path / "t"), "date_day", ["id"])
    assert acc.value == 600
    assert len(held(spark, str(tmp_path / "t"))) == 600


@pytest.mark.parametrize("window", [False, True])
def test_overwrites_that_read_their_table_are_computed_once(spark, tmp_path, window):
    path = str(tmp_path / "t")
    write_full(dated(spark, 300), path, "date_day", ["id"])
    third = list_files(spark, f"{path}/date_day=2024-01-03")
    first = spark.read.parquet(path).where(F.col("date_day") == F.lit(DAYS[0])).withColumn("id", F.col("id") + 1000)
    df, acc = counted(spark, first.repartition(3))  # no rows of the second day
    if window:
        overwrite_window(spark, df, path, "date_day", DAYS[0], ["id"])
    else:
        overwrite_values(spark, df, path, "date_day", {"2024-01-01", "2024-01-02"}, ["id"])
    assert acc.value == 100
    assert list_files(spark, f"{path}/date_day=2024-01-03") == ([] if window else third)
    want = [("2024-01-01", i + 1000) for i in range(0, 300, 3)] + ([] if window else [("2024-01-03", i) for i in range(2, 300, 3)])
    assert held(spark, path) == sorted(want)
    assert partition_values(spark, path, "date_day") == {d for d, _ in want}
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_an_empty_overwrite_drops_its_values(spark, tmp_path):
    path = str(tmp_path / "t")
    write_full(dated(spark, 30), path, "date_day", ["id"])
    overwrite_values(spark, spark.read.parquet(path).where("id < 0"), path, "date_day", {"2024-01-02"}, ["id"])
    assert partition_values(spark, path, "date_day") == {"2024-01-01", "2024-01-03"}


def test_a_big_date_is_written_by_several_tasks(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "64KB")
    try:
        write_full(dated(spark, 200_000, DAYS[:1]), str(tmp_path / "t"), "date_day", ["id"])
    finally:
        spark.conf.unset(size)
    assert len(list_files(spark, f"{tmp_path}/t/date_day=2024-01-01")) > 1


def test_sessions_collect_over_sorted_rows(spark):
    cfg = Config(as_of_date="2024-05-31")
    plan = sessions(dedupe_events(stage_events(raw_fixture(spark), cfg), cfg), cfg)._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan
