from pyspark.sql import functions as F

from contrail.operators.scd2 import scd2_init, scd2_merge
from contrail.session import scratch_path
from contrail.sources.scd2_table import read_scd2
from contrail.sources.sinks import write_table
from contrail.streaming import active_counts as S

SF = "/root/testdata/sf0.001"


import pytest


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_stream_counts_equal_batch(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        _stream_counts_equal_batch(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def _stream_counts_equal_batch(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    land = scratch_path(spark, "land")
    # Land the feed as several files so the stream sees several micro-batches.
    write_table(ev.repartition(4), land)
    out, ckpt = scratch_path(spark, "out"), scratch_path(spark, "ckpt")
    stream = S.file_stream(spark, land, ev.schema, max_files_per_trigger=1)
    q = S.start_window_counts(S.windowed_counts(stream, "ts", ["event_type"], "1 day", "40 days"), out, ckpt)
    q.awaitTermination()
    got = {(r.window_start, r.event_type): r.n for r in S.read_window_counts(spark, out, ["window_start", "event_type"])
           .collect()}
    want = {(r.d, r.event_type): r.n for r in ev.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("d"),
                                                         "event_type").count().withColumnRenamed("count", "n")
            .collect()}
    assert got == want


def test_stream_drops_replayed_records(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    land = scratch_path(spark, "land_dup")
    write_table(ev.coalesce(1), land)
    write_table(ev.coalesce(1), land)          # the same poll landed twice
    out, ckpt = scratch_path(spark, "out_dup"), scratch_path(spark, "ckpt_dup")
    counts = S.windowed_counts(S.file_stream(spark, land, ev.schema, max_files_per_trigger=1), "ts",
                               ["event_type"], "1 day", "40 days", dedup_keys=["event_id"])
    S.start_window_counts(counts, out, ckpt).awaitTermination()
    got = S.read_window_counts(spark, out, ["window_start", "event_type"]).agg(F.sum("n")).collect()[0][0]
    assert got == ev.count()


def test_scd2_stream_matches_batch_merges(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").drop("props")
    land = scratch_path(spark, "land_scd")
    split = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    first, second = ev.where(F.col("ts") < split), ev.where(F.col("ts") >= split)
    write_table(first.coalesce(1), land)
    table, ckpt = scratch_path(spark, "scd_table"), scratch_path(spark, "scd_ckpt")
    q = S.start_scd2_stream(S.file_stream(spark, land, ev.schema), table, "user_id", "ts", ["event_type"], ckpt,
                            tie_break=["event_id"])
    q.awaitTermination()
    write_table(second.coalesce(1), land)
    q = S.start_scd2_stream(S.file_stream(spark, land, ev.schema), table, "user_id", "ts", ["event_type"], ckpt,
                            tie_break=["event_id"])
    q.awaitTermination()
    got = read_scd2(spark, table)
    want = scd2_merge(scd2_init(first, "user_id", "ts", ["event_id"]), second, "user_id", "ts", ["event_type"],
                      ["event_id"])
    key = lambda r: (r.user_id, r.event_id, r.is_current, r.effective_time, r.end_time)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
