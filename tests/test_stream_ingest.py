"""The ingest stream against what landed, with failures between its writes."""

import pytest

from contrail.session import scratch_path
from contrail.sources.feeds import feed_schema, land_json
from contrail.sources.sinks import read_table
from contrail.streaming import ingest
from contrail.streaming.ingest import start_ingest


def _land(spark, landing, lo, hi, bad=()):
    land_json(spark.range(lo, hi).selectExpr("'c' || id AS Code", "'i' || id AS ICAO", "CASE WHEN id % 3 > 0 THEN 'n' END AS Name").repartition(3), landing)
    if bad:
        spark.createDataFrame([(b,) for b in bad], "value string").coalesce(1).write.mode("append").text(landing)


def _codes(spark, path):
    return sorted(int(r.Code[1:]) for r in read_table(spark, path).select("Code").collect())


def _bad(spark, bronze):
    return sorted(r[0] for r in spark.read.parquet(f"{bronze}/_quarantine").select("_corrupt_record").collect())


@pytest.mark.parametrize("fail_at", [1, 2, 3])
def test_replay_after_a_kill_ingests_each_line_once(spark, monkeypatch, fail_at):
    """The stream dies before, between and after the two writes of a batch, and runs again."""
    landing, bronze, ckpt = (scratch_path(spark, x) for x in ("si_land", "si_bronze", "si_ckpt"))
    _land(spark, landing, 0, 50, ['{"Code": ', "", "  "])
    real, calls = ingest.write_table, []

    def dying(*a, **kw):
        calls.append(1)
        if len(calls) == fail_at:
            if fail_at > 1:
                real(*a, **kw)
            raise RuntimeError("lost")
        real(*a, **kw)
    with monkeypatch.context() as m:
        m.setattr(ingest, "write_table", dying)
        with pytest.raises(Exception, match="lost"):
            start_ingest(spark, landing, feed_schema("airline"), bronze, ckpt, max_files_per_trigger=2).awaitTermination()
    _land(spark, landing, 50, 70, ["[broken"])                       # more lands before it is up again
    start_ingest(spark, landing, feed_schema("airline"), bronze, ckpt, max_files_per_trigger=2).awaitTermination()
    assert _codes(spark, bronze) == list(range(70)) and _bad(spark, bronze) == ["[broken", '{"Code": ']
    start_ingest(spark, landing, feed_schema("airline"), bronze, ckpt).awaitTermination()
    assert _codes(spark, bronze) == list(range(70)) and len(_bad(spark, bronze)) == 2


def test_runs_are_stamped_and_streams_keep_apart(spark):
    landing, bronze = scratch_path(spark, "si_land"), scratch_path(spark, "si_bronze")
    _land(spark, landing, 0, 5)
    start_ingest(spark, landing, feed_schema("airline"), bronze, scratch_path(spark, "c1"), "2024-05-06 07:08:09").awaitTermination()
    other = scratch_path(spark, "si_other")
    _land(spark, other, 5, 9)
    start_ingest(spark, other, feed_schema("airline"), bronze, scratch_path(spark, "c2"), "2024-05-06 07:08:09").awaitTermination()
    rows = read_table(spark, bronze)
    assert _codes(spark, bronze) == list(range(9))
    assert {(str(r.extract_year), r.extract_day, r.extract_time) for r in rows.collect()} == {("2024", "2024_05_06", 1714979289)}
    assert rows.select("ingest_batch").distinct().count() == 2


def test_nothing_landed(spark):
    landing, bronze = scratch_path(spark, "si_land"), scratch_path(spark, "si_bronze")
    spark.createDataFrame([("  ",), ("",)], "value string").coalesce(1).write.text(landing)
    start_ingest(spark, landing, feed_schema("airline"), bronze, scratch_path(spark, "c3"), "2024-05-06 07:08:09").awaitTermination()
    assert read_table(spark, bronze, feed_schema("airline")).count() == 0
