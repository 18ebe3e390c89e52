"""Marts kept from changes, late splicing and the active-flight stream against the same things computed at once."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from contrail.operators import indicators as I
from contrail.operators.current import active_flights, current_flights
from contrail.operators.dedup import dedup_latest
from contrail.operators.maintained import MART_COLUMNS, MARTS, add_changes, maintain_marts, read_mart, recompute_mart
from contrail.operators.scd2 import scd2_history, scd2_splice, scd2_timeline, timeline_history
from contrail.session import scratch_path
from contrail.sources.scd2_table import read_changes, read_scd2, upsert_scd2
from contrail.sources.sinks import read_version, write_table
from contrail.streaming import active_counts as S
from contrail.streaming.active_flights import active_changes, advance, start_active_counts
from helpers import plan_text, rows_of

T0 = dt.datetime(2024, 1, 1)
FLIGHTS = "id string, extract_ts timestamp_ntz, " + ", ".join(f"{c} string" for c in MART_COLUMNS)


def flights(spark, seed, ids, hour):
    rng = random.Random(seed)
    rows = []
    for i in ids:
        air = lambda: [rng.choice(["X", "Y", None]), "name", rng.choice(["A", "B", None]), "C", rng.choice(["1.5", "", "x"]), "2"]
        rows.append((i, T0 + dt.timedelta(hours=hour), rng.choice(["Air", "Bird", None]), "A1", rng.choice(["BOEING 7", "AIRBUS 3", None]),
                     rng.choice(["0", "0", "1"]), rng.choice(["Scheduled", "Landed 9:00", "Estimated"]), *air(), *air()))
    return spark.createDataFrame(rows, FLIGHTS)


def test_marts_equal_recomputation_after_every_batch(spark):
    silver, out = scratch_path(spark, "m_silver"), scratch_path(spark, "m_marts")
    ids = [f"{i:04d}" for i in range(300)]
    for n, mine in enumerate((ids[:200], ids[50:90] + ids[200:], ids[70:75], ids[:300])):
        upsert_scd2(spark, silver, flights(spark, n, mine, n), "id", "extract_ts", MART_COLUMNS, range_rows=40)
        assert maintain_marts(spark, silver, out) == n
        current = read_scd2(spark, silver, current_only=True)
        for name in MARTS:
            assert rows_of(read_mart(spark, out, name)) == rows_of(recompute_mart(current, name)), name
    before = {m: rows_of(read_version(spark, f"{out}/{m}")) for m in MARTS}
    maintain_marts(spark, silver, out)                                   # nothing new: nothing changes
    assert before == {m: rows_of(read_version(spark, f"{out}/{m}")) for m in MARTS}
    active = active_flights(current)
    assert rows_of(read_mart(spark, out, "current_flight_by_airline")) == rows_of(I.airline_counts(active))
    assert rows_of(read_mart(spark, out, "in_out_flight")) == rows_of(I.airport_in_out(current))
    assert rows_of(read_mart(spark, out, "regional_flight")) == rows_of(I.regional_counts(active))


def test_marts_read_no_unchanged_range(spark):
    """The changes of a batch come from that batch's folder, and that holds only the ranges it touched."""
    silver = scratch_path(spark, "m_plan")
    ids = [f"{i:04d}" for i in range(400)]
    upsert_scd2(spark, silver, flights(spark, 0, ids, 0), "id", "extract_ts", MART_COLUMNS, range_rows=20)
    upsert_scd2(spark, silver, flights(spark, 1, ids[100:104], 1), "id", "extract_ts", MART_COLUMNS, range_rows=20)
    changes = read_changes(spark, silver, 1)
    files = changes.inputFiles()
    assert files and all("/batch=1/" in f for f in files) and len({f.split("range=")[1].split("/")[0] for f in files}) <= 2
    plan = plan_text(add_changes(None, MARTS["current_flight_by_airline"][0](changes)))
    assert plan.count("Scan parquet") <= 2 and "batch=0" not in plan


def feed(spark, seed, n=300):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", "c", None]) if rng.random() < 0.7 else f"k{rng.randint(0, 20)}",
             None if rng.random() < 0.05 else T0 + dt.timedelta(minutes=rng.randint(0, 200)), i, rng.choice(["x", "y", None])) for i in range(n)]
    return rows, "key string, ts timestamp_ntz, no long, kind string"


@pytest.mark.parametrize("seed", [1, 2])
def test_splice_of_shuffled_batches_gives_the_history(spark, seed):
    rows, schema = feed(spark, seed)
    want = rows_of(scd2_history(spark.createDataFrame(rows, schema), "key", "ts", ["kind"], ["no"]))
    random.Random(seed + 10).shuffle(rows)
    timeline = None
    for a, b in ((0, 120), (120, 125), (100, 220), (220, 300)):           # one small batch, one with replays
        late = spark.createDataFrame(rows[a:b], schema)
        if timeline is None:
            parts = [scd2_timeline(late, "key", "ts", ["kind"], ["no"])]
        else:
            parts = scd2_splice(timeline, late, "key", "ts", ["kind"], ["no"])
        path = scratch_path(spark, "splice")
        for part in parts:
            write_table(part, path)
        timeline = spark.read.schema(parts[0].schema).parquet(path)
    assert rows_of(timeline_history(timeline)) == want


def test_splice_works_on_named_keys_only(spark):
    rows, schema = feed(spark, 5)
    timeline = scd2_timeline(spark.createDataFrame(rows, schema), "key", "ts", ["kind"], ["no"])
    late = spark.createDataFrame([("a", T0 + dt.timedelta(minutes=77, seconds=1), 1000, "new")], schema)
    untouched, repaired = scd2_splice(timeline, late, "key", "ts", ["kind"], ["no"])
    assert {r.key for r in repaired.select("key").distinct().collect()} == {"a"}
    assert untouched.where("key = 'a'").isEmpty() and untouched.where("key IS NULL").count() == sum(r[0] is None for r in rows)
    plan = plan_text(repaired, "simple")
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "EvalPython" not in plan


SNAP = "id string, extract_ts timestamp_ntz, airline_name string, on_ground string, status_text string, estimated_arrival timestamp_ntz, scheduled_time_arrival timestamp_ntz"


def snapshots(seed, hour, n=150):
    rng = random.Random(seed)
    at = lambda lo, hi: T0 + dt.timedelta(hours=hour, minutes=rng.randint(lo, hi))
    return [(f"f{i}" if i else None, at(0, 59), rng.choice(["Air", "Bird", None]), rng.choice(["0", "0", "1", "?"]),
             rng.choice(["Scheduled", "Estimated", "Landed 1:00", None]), rng.choice([None, at(0, 400)]), rng.choice([None, at(30, 300)]))
            for i in rng.sample(range(200), n)]


def batch_counts(spark, rows):
    df = dedup_latest(spark.createDataFrame(rows, SNAP), "id", [F.col("extract_ts").desc(), F.col("status_text")])
    now = max(r[1] for r in rows)
    return rows_of(active_flights(current_flights(df, now)).groupBy("airline_name").agg(F.count(F.lit(1)).alias("n")))


def test_active_stream_equals_batch_after_every_drop(spark):
    land, out, ckpt = (scratch_path(spark, x) for x in ("af_land", "af_out", "af_ckpt"))
    rows, schema = [], spark.createDataFrame([], SNAP).schema

    def drain(to, checkpoint):
        stream = S.file_stream(spark, land, schema)
        start_active_counts(active_changes(stream, "id", "extract_ts", ["airline_name"], state_groups=4), ["airline_name"], to, checkpoint).awaitTermination()
        return rows_of(read_version(spark, to))
    for hour in range(3):
        drop = snapshots(hour, hour)
        rows += drop
        write_table(spark.createDataFrame(drop, SNAP).repartition(2), land)
        assert drain(out, ckpt) == batch_counts(spark, rows)
    assert drain(out, ckpt) == batch_counts(spark, rows)                 # nothing landed: nothing changes
    replay = [r for r in rows if r[1] >= max(x[1] for x in rows) - dt.timedelta(minutes=20)]
    write_table(spark.createDataFrame(replay, SNAP), land)               # the same snapshots once more
    assert drain(out, ckpt) == batch_counts(spark, rows)


def test_replayed_micro_batch_is_added_once(spark):
    from contrail.sources.commits import commits
    out = scratch_path(spark, "af_replay")
    land, ckpt = scratch_path(spark, "af_land2"), scratch_path(spark, "af_ckpt2")
    write_table(spark.createDataFrame(snapshots(1, 0), SNAP), land)
    stream = S.file_stream(spark, land, spark.createDataFrame([], SNAP).schema)
    changes = active_changes(stream, "id", "extract_ts", ["airline_name"], state_groups=2)
    start_active_counts(changes, ["airline_name"], out, ckpt).awaitTermination()
    once = rows_of(read_version(spark, out))
    fs = spark._jvm.org.apache.hadoop.fs.Path(ckpt).getFileSystem(spark._jsc.hadoopConfiguration())
    last = max(r.source_id for r in commits(spark, out).collect())
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{ckpt}/commits/{last}"), False)   # the stream died before its own commit
    start_active_counts(active_changes(stream, "id", "extract_ts", ["airline_name"], state_groups=2), ["airline_name"], out, ckpt).awaitTermination()
    assert rows_of(read_version(spark, out)) == once


def test_advance_takes_counts_back():
    cols = ["flight", "at", "until", "counted", "g0"]
    old = pd.DataFrame([["a", 5, 1 << 62, True, "X"], ["b", 5, 40, True, "X"], ["c", 5, 7, False, "Y"]], columns=cols)
    new = pd.DataFrame([["a", 6, 1 << 62, True, "Y"], ["c", 4, 1 << 62, True, "Z"], [None, 9, 90, True, None]], columns=cols)
    last, moved = advance(old, new, 50, ["g0"])
    assert {tuple(r) for r in moved.where(moved.notna(), None).itertuples(index=False)} == {("X", -2), ("Y", 1), (None, 1)}
    assert set(last["flight"].where(last["flight"].notna(), None)) == {"a", None}
