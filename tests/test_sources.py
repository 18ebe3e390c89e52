import json
import os

import pytest
from pyspark.sql import types as T

from contrail.session import scratch_path
from contrail.sources import feeds, sinks

# Daily movements per airport, partitioned by the day's folders.
MOVES = [("CDG", 612, "2023", "2023_11", "2023_11_30"), ("FRA", 544, "2023", "2023_12", "2023_12_01"),
         ("LIS", 301, "2024", "2024_02", "2024_02_29")]
MOVES_SCHEMA = T.StructType([T.StructField("airport", T.StringType()), T.StructField("movements", T.IntegerType()),
                             *[T.StructField(f"extract_{c}", T.StringType()) for c in ("year", "month", "day")]])
DAY = ["extract_year", "extract_month", "extract_day"]


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_partitioned_write_folders_and_read_back(spark):
    path = scratch_path(spark, "moves")
    sinks.write_table(spark.createDataFrame(MOVES, MOVES_SCHEMA), path, DAY)
    assert os.path.isdir(os.path.join(_local(path), "extract_year=2024", "extract_month=2024_02", "extract_day=2024_02_29"))
    back = sinks.read_table(spark, path, MOVES_SCHEMA)
    assert back.schema == MOVES_SCHEMA
    assert sorted(map(tuple, back.collect())) == sorted(MOVES)


def test_single_string_partition_column(spark):
    path = scratch_path(spark, "moves1")
    sinks.write_table(spark.createDataFrame(MOVES, MOVES_SCHEMA), path, "airport")
    assert os.path.isdir(os.path.join(_local(path), "airport=FRA"))


RUN_SCHEMA = "k string, v int, extract_year string, extract_month string, extract_day string, extract_time bigint"


def test_run_is_replaced_as_a_whole_and_latest_run(spark):
    path = scratch_path(spark, "mart")
    mart = lambda rows: spark.createDataFrame(rows, "k string, v int")
    early, late = "2024-05-06 07:00:00", "2024-05-06 08:00:00"
    for rows in ([("a", 1), ("b", 2), ("c", 3)], [("a", 1), ("b", 2)]):
        sinks.write_run(mart(rows), path, early)
    sinks.write_run(mart([("a", 9)]), path, late)
    full = sinks.read_table(spark, path, T._parse_datatype_string(RUN_SCHEMA))
    assert full.count() == 3
    last = sinks.latest_run(full)
    assert [tuple(r)[:5] for r in last.collect()] == [("a", 9, "2024", "2024_05", "2024_05_06")]
    from helpers import plan_text
    assert "PartitionFilters: [isnotnull(extract_time" in plan_text(last) and "subquery" in plan_text(last)
    sinks.write_run(mart([]), path, late)
    assert sinks.read_table(spark, path, T._parse_datatype_string(RUN_SCHEMA)).count() == 2


def test_versions_replace_the_whole_table(spark):
    path = scratch_path(spark, "serving")
    flags = lambda rows: spark.createDataFrame(rows, "id int, is_current boolean")
    with pytest.raises(FileNotFoundError):
        sinks.read_version(spark, path)
    sinks.write_version(flags([(1, True), (2, True)]), path, "is_current")
    sinks.write_version(flags([(1, True), (2, False)]), path, "is_current")
    got = lambda: sorted((r.id, r.is_current) for r in sinks.read_version(spark, path, flags([]).schema).collect())
    assert got() == [(1, True), (2, False)]
    sinks.write_table(flags([(7, True)]), f"{path}/version=2", "is_current", mode="replace")      # died before its commit
    assert got() == [(1, True), (2, False)]
    sinks.write_version(flags([(3, True)]), path, "is_current")
    assert got() == [(3, True)]


def test_schema_round_trip_and_bad_schema(tmp_path):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("age", T.IntegerType())])
    p = tmp_path / "s.json"
    p.write_text(schema.json())
    assert feeds.load_schema(str(p)) == schema
    bad = tmp_path / "bad.json"
    bad.write_text('{"type": "struct", "fields": [{"name": "a", "type": "string", "nullable": true},]}')
    with pytest.raises(json.JSONDecodeError):
        feeds.load_schema(str(bad))


def test_ingest_json_with_stamp_and_quarantine(spark):
    path = scratch_path(spark, "landing")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("age", T.IntegerType())])
    spark.createDataFrame([('{"id": 1, "name": "John", "age": 30}',), ('{"id": 2, "name": "Alice", "age": 25}',),
                           ('{"id": 3, "name": ',)], "value string").write.text(path)
    good, bad = feeds.ingest_json(spark, path, schema, as_of="2024-05-06 07:08:09")
    rows = good.collect()
    assert len(rows) == 2 and bad.count() == 1
    assert set(good.columns) == {"id", "name", "age", "extract_year", "extract_month", "extract_day",
                                 "extract_time"}
    r = rows[0]
    assert (r.extract_year, r.extract_month, r.extract_day) == ("2024", "2024_05", "2024_05_06")
    assert r.extract_time == 1714979289


def test_scan_pushes_filter_and_prunes_columns(spark):
    from helpers import plan_text
    df = feeds.read_feed(spark, "/root/testdata/sf0.001/lineitem.parquet", where="l_returnflag = 'R'",
                         columns=["l_orderkey", "l_quantity"])
    plan = plan_text(df)
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in plan


def test_bronze_takes_every_file_once(spark):
    landing, bronze = scratch_path(spark, "landing_b"), scratch_path(spark, "bronze_b")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    land = lambda lines: spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(landing)
    land(['{"id": 1, "name": "A"}', '{"id": 2, "name": "B"}', '{"id": ', ""])
    r1 = feeds.ingest_to_bronze(spark, landing, schema, bronze, "2024-05-06 07:00:00")
    feeds.ingest_to_bronze(spark, landing, schema, bronze, "2024-05-06 07:00:00")       # retry of the same run
    land(['{"id": 3, "name": "C"}'])
    r2 = feeds.ingest_to_bronze(spark, landing, schema, bronze, "2024-05-06 08:00:00")  # next run: the new file only
    assert r2 - r1 == 3600
    rows = sorted((r.extract_time, r.id) for r in spark.read.parquet(bronze).collect())
    assert rows == [(r1, 1), (r1, 2), (r2, 3)]
    q = spark.read.parquet(f"{bronze}/_quarantine")
    assert [(r._corrupt_record, r.extract_time) for r in q.collect()] == [('{"id": ', r1)]
    feeds.ingest_to_bronze(spark, landing, schema, bronze, "2024-05-06 09:00:00")       # nothing has landed
    assert spark.read.parquet(bronze).count() == 3


def test_files_per_value_bounds_small_files(spark):
    path = scratch_path(spark, "fpv")
    df = spark.range(0, 2000).selectExpr("id", "CAST(id % 3 AS STRING) AS day").repartition(16)
    sinks.write_table(df, path, "day", files_per_value=2)
    for day in ("0", "1", "2"):
        folder = os.path.join(_local(path), f"day={day}")
        files = [f for f in os.listdir(folder) if f.endswith(".parquet")]
        assert 1 <= len(files) <= 2
    assert sinks.read_table(spark, path).count() == 2000
