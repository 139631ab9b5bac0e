"""Readers: CSV export with quoted JSON, connection union, case policy."""

import datetime as dt

from eventlens.config import Config
from eventlens.operators.dedupe import dedupe_events
from eventlens.operators.staging import stage_events
from eventlens.sources.events import read_events_csv, union_connections

CSV = '''_file,_line,loader_row_id,event_id,name,time,distinct_id,properties,insert_id,mp_processing_time_ms,loaded_at,screen_width,wifi,os
x.csv,1,id1,11,Watch,2021-05-01 10:00:00,u-1,"{""Screen Size"": ""XL"",""headline"": ""a 'quoted' word"",""clip"": 12}",i1,1001,2021-05-03 08:00:00,1280,true,ios
x.csv,2,id2,12,watch,2021-05-02 11:30:00,u-1,"{""Screen Size"": ""Phone"",""headline"": ""b""}",i1,1002,2021-05-03 08:00:00,,,
'''


def test_csv_source_with_quoted_json(spark, tmp_path):
    path = tmp_path / "event.csv"
    path.write_text(CSV)
    raw = read_events_csv(spark, str(path))
    cfg = Config(as_of_date=dt.date(2021, 5, 31), source_name="Test.Conn",
                 properties_to_pivot=("Screen Size", "headline"))
    ev = dedupe_events(stage_events(raw, cfg), cfg)
    rows = {r["loader_row_id"]: r for r in ev.collect()}
    assert set(rows) == {"id1", "id2"}  # same insert id on two days is not a duplicate
    r1 = rows["id1"]
    assert r1["screen_size"] == "XL" and r1["headline"] == "a 'quoted' word"
    assert r1["screen_width"] == 1280 and r1["has_wifi_connected"] is True and r1["os"] == "ios"
    assert r1["occurred_at"] == dt.datetime(2021, 5, 1, 10) and r1["source_relation"] == "test.conn"
    assert rows["id2"]["screen_width"] is None and rows["id2"]["event_type"] == "watch"


def test_union_connections_tags_and_fills(spark):
    a = spark.createDataFrame([("x", "u1")], "name string, distinct_id string")
    b = spark.createDataFrame([("y", "u1", "d1")], "name string, distinct_id string, device_id string")
    u = union_connections({"Warehouse.A": a, "warehouse.b": b})
    got = sorted((r["source_relation"], r["device_id"]) for r in u.collect())
    assert got == [("warehouse.a", None), ("warehouse.b", "d1")]
    kept = union_connections({"Warehouse.A": a}, preserve_case=True)
    assert kept.first()["source_relation"] == "Warehouse.A"
    stg = stage_events(kept, Config(preserve_source_case=True))
    assert stg.first()["source_relation"] == "Warehouse.A"


def test_custom_column_transform(spark):
    raw = spark.createDataFrame([("x", "u1", "3.5")], "name string, distinct_id string, app_price string")
    cfg = Config(custom_columns=[{"name": "app_price", "alias": "price", "transform_sql": "cast(app_price as double)"},
                                 {"name": "app_price"}])
    row = stage_events(raw, cfg).first()
    assert row["price"] == 3.5 and row["app_price"] == "3.5"


def test_global_filter_uses_raw_names(spark):
    raw = spark.createDataFrame([("x", "u1"), ("y", "u2")], "name string, distinct_id string")
    stg = stage_events(raw, Config(event_filter="distinct_id != 'u2'"))
    assert [r["people_id"] for r in stg.collect()] == ["u1"]


def test_read_events_from_catalog_table(spark):
    from eventlens.sources.events import read_events

    raw = spark.createDataFrame([("x", "u1")], "name string, distinct_id string")
    raw.createOrReplaceTempView("raw_events_view")
    assert read_events(spark, "raw_events_view", fmt="table").count() == 1


def test_staged_frames_keep_columns_that_one_side_lacks(spark):
    a = spark.createDataFrame([("view", "u1", "i1")], "name string, distinct_id string, insert_id string").selectExpr("*", "timestamp_ntz'2024-01-01 10:00:00' AS time")
    b = spark.createDataFrame([("view", 5, "i2", "ios")], "name string, distinct_id bigint, insert_id string, os string").selectExpr("*", "timestamp_ntz'2024-01-01 10:00:00' AS time")
    cfg = Config(as_of_date="2024-01-02")
    staged = stage_events(a, cfg).unionByName(stage_events(b, cfg))
    assert {(r["people_id"], r["os"]) for r in dedupe_events(staged, cfg).collect()} == {("u1", None), ("5", "ios")}
    united = stage_events(union_connections({"a": a, "b": b}), cfg)
    assert {(r["people_id"], r["os"], r["source_relation"]) for r in dedupe_events(united, cfg).collect()} == {("u1", None, "a"), ("5", "ios", "b")}


def test_raw_names_map_a_loaders_columns(spark):
    raw = spark.createDataFrame([("view", "row-1")], "name string, row_no string")
    row = stage_events(raw, Config(raw_names={"loader_row_id": "row_no"})).first()
    assert row["loader_row_id"] == "row-1"


def test_unnamed_path_with_a_partition_folder(spark, tmp_path):
    from eventlens.__main__ import load_raw

    path = f"{tmp_path}/raw/dt=2024-01-01"
    spark.createDataFrame([("view",)], "name string").write.parquet(path)
    assert load_raw(spark, [path], "parquet").count() == 1
