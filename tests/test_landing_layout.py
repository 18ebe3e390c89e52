"""Detail records that do not parse, point reads, packed runs and continents by time zone."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.operators import indicators as I
from contrail.operators.dims import ZONE_CONTINENTS, zone_continents, zone_prefix_dim
from contrail.plans.queries import QUERIES
from contrail.session import scratch_path
from contrail.sources import feeds, sinks
from contrail.sources.compaction import PACKED, compact_runs, read_runs
from helpers import plan_text, rows_of

STAMPS = [T.StructField(c, T.StringType()) for c in sinks.RUN_PARTITIONS[:3]] + [T.StructField("extract_time", T.LongType())]
RUNS = T.StructType([T.StructField("id", T.LongType()), *STAMPS])


def _ingest(spark, lines):
    landing, bronze = scratch_path(spark, "ll_land"), scratch_path(spark, "ll_bronze")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(landing)
    feeds.ingest_to_bronze(spark, landing, feeds.feed_schema("detail"), bronze, "2024-05-06 07:08:09")
    bad = spark.read.schema("_corrupt_record string, failed_fields array<string>").parquet(f"{bronze}/_quarantine")
    return sinks.read_table(spark, bronze, feeds.feed_schema("detail")), bad


def test_detail_schema_has_its_fields(spark):
    schema = feeds.feed_schema("detail")
    assert len(schema) == 63 == len(set(schema.names))
    kinds = [f.dataType.typeName() for f in schema]
    assert (kinds.count("array"), kinds.count("struct"), kinds.count("string")) == (2, 1, 60)


def test_broken_details_say_what_failed(spark):
    leg = {"identification": {"id": "L1"}, "airport": {"origin": {"code": {"iata": "AAA"}}}}
    good, bad = _ingest(spark, [
        json.dumps({"id": "ok", "aircraft_history": [leg, None], "time_details": {"real": {"departure": "17"}}, "trail": []}),
        json.dumps({"id": "extra", "not_declared": {"x": 1}, "time_details": None, "trail": None}),
        json.dumps({"id": "s", "time_details": "later"}),
        json.dumps({"id": "list", "time_details": []}),
        json.dumps({"id": "two", "trail": {"lat": 1}, "aircraft_history": "none"}),
        json.dumps({"id": "deep", "aircraft_history": [{"airport": {"origin": {"code": 5}}}]}),
        '{"id": "cut', "no record", "   "])
    assert {r.id for r in good.collect()} == {"ok", "extra"}
    ok = good.where("id = 'ok'").select("aircraft_history.airport.origin.code.iata", "time_details.real.departure", F.size("trail")).first()
    assert (ok[0], ok[1], ok[2]) == (["AAA", None], "17", 0)
    found = {r._corrupt_record: sorted(r.failed_fields) for r in bad.collect()}
    assert {json.loads(k)["id"]: v for k, v in found.items() if v != [feeds.MALFORMED]} == {
        "s": ["time_details"], "list": ["time_details"], "two": ["aircraft_history", "trail"], "deep": ["aircraft_history"]}
    assert {k for k, v in found.items() if v == [feeds.MALFORMED]} == {'{"id": "cut', "no record"}


def test_nothing_landed_gives_empty_tables(spark):
    good, bad = _ingest(spark, [""])
    assert good.count() == 0 and bad.count() == 0


def _rows_scanned(df) -> int:
    df.collect()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "Scan" in node.nodeName():
            n += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return n


def test_point_read_skips_row_groups(spark):
    """Ids come as hashes, so every file spans all of them: bounds alone leave a row group in each."""
    path, plain = scratch_path(spark, "ll_idx"), scratch_path(spark, "ll_plain")
    rows = spark.range(0, 400_000, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("id"), F.rand(1).alias("x"))
    sinks.write_indexed(rows, path, "id", row_group_bytes=256 << 10)
    sinks.write_table(rows, plain)
    one = F.sha2(F.lit("77"), 256)
    key = spark.range(1).select(one.alias("k")).first().k
    hit, full = (feeds.read_feed(spark, p, where=f"id = '{key}'") for p in (path, plain))
    assert rows_of(hit) == rows_of(full) and hit.count() == 1
    assert "EqualTo(id," in plan_text(hit)
    assert _rows_scanned(full) == 400_000 and 1 <= _rows_scanned(hit) <= 20_000
    assert _rows_scanned(feeds.read_feed(spark, path, where="id = 'none of them'")) == 0


def _run_rows(spark, hours, lo=0, n=60):
    ids = spark.range(lo, lo + n, 1, 3).withColumn("at", F.to_timestamp_ntz(F.concat(
        F.lit("2024-05-06 "), F.lpad((F.element_at(F.array(*map(F.lit, hours)), (F.col("id") % len(hours) + 1).cast("int"))).cast("string"), 2, "0"),
        F.lit(":00:00"))))
    return feeds.stamp_extract(ids, "at").drop("at")


def _files(df):
    return {r.f for r in df.select(F.input_file_name().alias("f")).distinct().collect()}


def test_hourly_runs_become_few_files(spark):
    path = scratch_path(spark, "ll_hourly")
    sinks.write_table(_run_rows(spark, list(range(24)), n=480), path, sinks.RUN_PARTITIONS)
    raw = sinks.read_table(spark, path, RUNS)
    before, files, newest = rows_of(raw), len(_files(raw)), rows_of(sinks.latest_run(raw))
    day = min(r.extract_time for r in raw.collect())
    assert compact_runs(spark, path, day + 24 * 3600, RUNS) == 0
    packed = read_runs(spark, path, RUNS)
    assert packed.schema == raw.schema and rows_of(packed) == before
    assert files >= 24 and len(_files(packed)) <= 2
    assert rows_of(sinks.latest_run(packed)) == newest
    assert compact_runs(spark, path, day + 24 * 3600, RUNS) is None           # nothing left to pack


def test_packing_goes_on_and_takes_late_runs(spark):
    path = scratch_path(spark, "ll_more")
    sinks.write_table(_run_rows(spark, [0, 1, 3]), path, sinks.RUN_PARTITIONS)
    first = min(r.extract_time for r in sinks.read_table(spark, path, RUNS).collect())
    assert compact_runs(spark, path, first + 2 * 3600, RUNS) == 0
    assert len(rows_of(read_runs(spark, path, RUNS))) == 60
    sinks.write_table(_run_rows(spark, [1 + 1], lo=100), path, sinks.RUN_PARTITIONS)           # a new run past the end
    sinks.write_table(_run_rows(spark, [4], lo=200), path, sinks.RUN_PARTITIONS)
    assert len(rows_of(read_runs(spark, path, RUNS))) == 180
    assert compact_runs(spark, path, first + 4 * 3600, RUNS) == 1
    sinks.write_table(_run_rows(spark, [3], lo=300).withColumn("extract_time", F.col("extract_time") - 60), path, sinks.RUN_PARTITIONS)
    assert compact_runs(spark, path, first + 4 * 3600, RUNS) == 2                              # the late run alone
    assert rows_of(read_runs(spark, path, RUNS)) == rows_of(sinks.read_table(spark, path, RUNS))


def test_half_written_pack_is_not_read(spark, monkeypatch):
    from contrail.sources import compaction
    path = scratch_path(spark, "ll_half")
    sinks.write_table(_run_rows(spark, [0, 1]), path, sinks.RUN_PARTITIONS)
    rows = rows_of(sinks.read_table(spark, path, RUNS))
    with monkeypatch.context() as m:
        m.setattr(compaction, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            compact_runs(spark, path, 1 << 40, RUNS)
    assert spark.read.parquet(f"{path}/{PACKED}/version=0").count() == 60
    assert rows_of(read_runs(spark, path, RUNS)) == rows
    assert compact_runs(spark, path, 1 << 40, RUNS) == 0 and rows_of(read_runs(spark, path, RUNS)) == rows


def test_longest_zone_prefix_wins(spark):
    zones = spark.createDataFrame([(z,) for z in (
        "America/Argentina/Buenos_Aires", "Atlantic/Reykjavik", "Atlantic/Nowhere", "Pacific/Easter", "Pacific/Fiji", "Asia", "",
        None, "Asia/Tokyo", "Asia/Tokyo", "Americas/Lima")], "tz string")
    got = {r.zone: r.continent for r in zone_continents(zones, zone_prefix_dim(spark)).collect()}
    assert got == {"America/Argentina/Buenos_Aires": "AMERICA", "Atlantic/Reykjavik": "EUROPE", "Pacific/Easter": "AMERICA",
                   "Pacific/Fiji": "OCEANIA", "Asia": "ASIA", "Asia/Tokyo": "ASIA"}
    assert set(ZONE_CONTINENTS.values()) <= {"AFRICA", "AMERICA", "ANTARCTICA", "ASIA", "EUROPE", "OCEANIA"}


def test_unknown_countries_get_a_continent_by_zone(spark):
    rows = spark.createDataFrame([("A", "Asia/Tokyo"), ("B", "Asia/Tokyo"), ("B", None), (None, "Europe/Rome"), ("Z", "Mars/Base")],
                                 "origin_airport_country_name string, origin_airport_timezone_name string")
    known = spark.createDataFrame([("A", "AFRICA"), ("Z", None)], "country string, continent string")
    out = I.with_continent(rows, known, zone_prefixes=zone_prefix_dim(spark))
    assert sorted(((r[0], r[1], r.continent) for r in out.collect()), key=str) == sorted([
        ("A", "Asia/Tokyo", "AFRICA"), ("B", "Asia/Tokyo", "ASIA"), ("B", None, None), (None, "Europe/Rome", "EUROPE"),
        ("Z", "Mars/Base", None)], key=str)
    plan = plan_text(QUERIES["top_regional_airline_by_zone"](spark, "/root/testdata/sf0.001"), "simple")
    assert "NestedLoop" not in plan and "Cartesian" not in plan
