from pyspark.sql import functions as F

from contrail.plans import queries as Q
from contrail.plans import views as V
from contrail.sources import feeds, sinks
from conftest import SF_SMALL
from helpers import plan_text, rows_of

SCHEMA = "n INT, t STRING, s STRUCT<x INT, y STRING>, o STRUCT<a STRING, b STRUCT<c STRING>>, l ARRAY<STRING>, m MAP<STRING, STRUCT<d STRING>>"
GOOD = ['{"n": 1, "t": "a"}', '{"t": {"k": [1]}, "o": null}', '{"o": {"a": 5, "b": {"c": [1]}}, "l": [1, {"q": 2}]}', "{}", '{"m": {"k": {"d": 1}}}',
        '{"n": 2, "other": [1, {"z": 3}]}']
BAD = ['{"n": "x"}', '{"o": 3}', '{"o": {"a": 1, "b": "c"}}', '{"s": {"x": "q"}}', '{"l": {}}', '{"m": {"k": 1}}', '{"m": []}', '{"t": "a', '{"t": "\\q"}',
       '{"o": {"a": ', "[1]", "7", '{"l": [1, 2}', '{"n": 1, "t": }']


def test_lines_fail_by_shape_as_they_do_by_all_fields(spark):
    schema = feeds.T._parse_datatype_string(SCHEMA)
    lines = spark.createDataFrame([(t,) for t in [*GOOD, *BAD, "", "  "]], "value STRING")
    good, bad = feeds.parse_json_lines(lines, schema)
    assert good.count() == len(GOOD) and sorted(r[0] for r in bad.select(feeds.CORRUPT_COLUMN).collect()) == sorted(BAD)
    # which lines are broken is found without the fields that any value fits
    condition = next(line for line in plan_text(bad.select(feeds.CORRUPT_COLUMN), "simple").splitlines() if "Filter" in line and "from_json" in line)
    assert "(a,StringType" not in condition.split(" ELSE ")[0]


def test_long_lines_are_tested_under_all_fields(spark, monkeypatch):
    monkeypatch.setattr(feeds, "LONG_LINE_BYTES", 12, raising=False)
    test_good, test_bad = feeds.parse_json_lines(spark.createDataFrame([(t,) for t in GOOD + BAD], "value STRING"),
                                                 feeds.T._parse_datatype_string(SCHEMA))
    assert test_good.count() == len(GOOD) and test_bad.count() == len(BAD)


def test_only_files_with_broken_records_are_read_twice(spark, tmp_path, monkeypatch):
    land, bronze, schema = str(tmp_path / "land in"), str(tmp_path / "bronze"), feeds.T._parse_datatype_string(SCHEMA)
    texts = spark.createDataFrame([(i, t) for i, t in enumerate([*GOOD, *BAD])], "i INT, value STRING")
    for part in (F.col("i") < len(GOOD), F.col("i") >= len(GOOD), F.col("i") == len(GOOD)):
        texts.where(part).select("value").coalesce(1).write.mode("append").text(land)
    texts.where("i = 0").unionAll(texts.where(f"i = {len(GOOD)}")).select("value").coalesce(1).write.mode("append").text(land)
    quarantined, real = [], sinks.write_run
    monkeypatch.setattr(sinks, "write_run", lambda df, path, *a, **k: (quarantined.append(df) if path.endswith("_quarantine") else None) or real(df, path, *a, **k))
    feeds.ingest_to_bronze(spark, land, schema, bronze, "1998-01-01 00:00:00")
    assert sinks.read_table(spark, bronze).count() == len(GOOD) + 1
    assert rows_of(spark.read.parquet(f"{bronze}/_quarantine").select(feeds.CORRUPT_COLUMN)) == sorted((t,) for t in [*BAD, BAD[0], BAD[0]])
    assert len(quarantined[0].inputFiles()) == 4 and quarantined[0].select(F.input_file_name()).distinct().count() == 3
    # a run without a broken record reads nothing again
    texts.where(F.col("i") < 2).select("value").coalesce(1).write.mode("append").text(land)
    feeds.ingest_to_bronze(spark, land, schema, bronze, "1998-01-01 01:00:00")
    assert "FileScan text" not in plan_text(quarantined[1], "simple")
    assert sinks.read_table(spark, bronze).count() == len(GOOD) + 3


def test_the_detail_feed_counts_legs_by_one_leaf(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = plan_text(Q.q_ingest_detail_feed(spark, SF_SMALL), "simple")
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    read = next(part for part in plan.split("ReadSchema: ")[1:]).splitlines()[0]
    assert "website" not in read and "spd" not in read and "iata" in read and "trail" in read


def test_views_that_are_not_sorted_are_not_dealt(spark, monkeypatch):
    for k, v in {"spark.sql.files.maxPartitionBytes": "16k", "contrail.broadcast.maxBytes": "0"}.items():
        spark.conf.set(k, v)
    try:
        assert "REPARTITION_BY_NUM" not in plan_text(V.detail_feed(spark, SF_SMALL), "simple")
        assert "REPARTITION_BY_NUM" in plan_text(V.flight_view(spark, SF_SMALL, for_sort=True), "simple")
        assert rows_of(V.flight_view(spark, SF_SMALL)) == rows_of(V.flight_view(spark, SF_SMALL, for_sort=True))
    finally:
        for k in ("spark.sql.files.maxPartitionBytes", "contrail.broadcast.maxBytes"):
            spark.conf.unset(k)
