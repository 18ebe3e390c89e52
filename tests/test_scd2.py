import datetime as dt

from pyspark.sql import functions as F

from contrail.operators.scd2 import scd2_as_of, scd2_history, scd2_init, scd2_merge

T0 = dt.datetime(2024, 1, 1)


def t(h):
    return T0 + dt.timedelta(hours=h)


SCHEMA = "id string, name string, gate string, ts timestamp_ntz"     # one flight: its status and its gate


def _first(spark):
    rows = [("LH12", "scheduled", "A1", t(0)), ("AF7", "boarding", None, t(0)), ("TP3", "delayed", "C9", t(0)),
            ("KL9", "scheduled", "D2", t(0))]
    return scd2_init(spark.createDataFrame(rows, SCHEMA), "id", "ts")


def _by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.id, []).append(r)
    return {k: sorted(v, key=lambda r: r.effective_time) for k, v in out.items()}


def test_first_load_columns(spark):
    h = _first(spark)
    assert set(h.columns) >= {"is_current", "effective_time", "end_time"}
    rows = h.collect()
    assert len(rows) == 4 and all(r.is_current and r.end_time is None for r in rows)


def test_upsert_closes_and_inserts(spark):
    upd = spark.createDataFrame([("LH12", "airborne", "A1", t(1)), ("AF7", "boarding", "B4", t(1))], SCHEMA)
    rows = scd2_merge(_first(spark), upd, "id", "ts", ["name", "gate"]).collect()
    assert len(rows) == 6
    assert sorted(r.id for r in rows if r.is_current) == ["AF7", "KL9", "LH12", "TP3"]
    closed = [r for r in rows if not r.is_current]
    assert sorted(r.id for r in closed) == ["AF7", "LH12"] and all(r.end_time == t(1) for r in closed)


def test_unchanged_new_absent_keys(spark):
    upd = spark.createDataFrame([("LH12", "scheduled", "A1", t(1)), ("IB5", "scheduled", "E1", t(1))], SCHEMA)
    out = _by_id(scd2_merge(_first(spark), upd, "id", "ts", ["name", "gate"]))
    assert len(out["LH12"]) == 1 and out["LH12"][0].effective_time == t(0)   # unchanged: nothing
    assert len(out["TP3"]) == 1 and out["TP3"][0].is_current                 # absent: untouched
    assert len(out["IB5"]) == 1 and out["IB5"][0].is_current                 # new: inserted


def test_null_keys_and_null_times_are_kept(spark):
    base = [(None, "scheduled", "X", t(0)), ("NT", "scheduled", "Y", None), ("LH12", "scheduled", "A1", t(0))]
    upd = [(None, "airborne", "X", t(1)), ("NT", "airborne", "Y", t(1)), ("LH12", "airborne", "A1", None),
           ("NEW", "scheduled", "Z", None)]
    h = scd2_merge(scd2_init(spark.createDataFrame(base, SCHEMA), "id", "ts"), spark.createDataFrame(upd, SCHEMA),
                   "id", "ts", ["name"])
    rows = [(r.id, r.name, r.is_current, r.effective_time, r.end_time) for r in h.collect()]
    assert sorted(rows, key=repr) == sorted([
        (None, "scheduled", False, t(0), t(1)), (None, "airborne", True, t(1), None),
        ("NT", "scheduled", False, None, t(1)), ("NT", "airborne", True, t(1), None),
        ("LH12", "scheduled", True, t(0), None),            # an update without a time replaces nothing
        ("NEW", "scheduled", True, None, None)], key=repr)
    again = scd2_merge(h, spark.createDataFrame(upd, SCHEMA), "id", "ts", ["name"])
    assert sorted(map(repr, again.collect())) == sorted(map(repr, h.collect()))


def test_history_of_null_keys_and_times(spark):
    feed = [(None, "a", "X", t(0)), (None, "b", "X", t(1)), ("K", "a", "X", None), ("K", "b", "X", t(2)), ("K", "b", "X", t(3))]
    got = [(r.id, r.name, r.effective_time, r.end_time, r.is_current)
           for r in scd2_history(spark.createDataFrame(feed, SCHEMA), "id", "ts", ["name"]).collect()]
    assert sorted(got, key=repr) == sorted([
        (None, "a", t(0), t(1), False), (None, "b", t(1), None, True),
        ("K", "a", None, t(2), False), ("K", "b", t(2), None, True)], key=repr)


def test_null_to_value_is_a_change_when_nullsafe(spark):
    base = scd2_init(spark.createDataFrame([("LH12", None, "A1", t(0))], SCHEMA), "id", "ts")
    upd = spark.createDataFrame([("LH12", "scheduled", "A1", t(1))], SCHEMA)
    assert scd2_merge(base, upd, "id", "ts", ["name"]).count() == 2
    assert scd2_merge(base, upd, "id", "ts", ["name"], nullsafe=False).count() == 1


def test_duplicate_keys_in_one_batch_take_latest(spark):
    upd = spark.createDataFrame([("LH12", "airborne", "A1", t(2)), ("LH12", "boarding", "A2", t(1))], SCHEMA)
    out = _by_id(scd2_merge(_first(spark), upd, "id", "ts", ["name", "gate"]))["LH12"]
    assert [r.name for r in out] == ["scheduled", "airborne"]
    assert sum(r.is_current for r in out) == 1


def test_late_older_snapshot_is_ignored(spark):
    upd = spark.createDataFrame([("LH12", "airborne", "A1", t(5))], SCHEMA)
    h = scd2_merge(_first(spark), upd, "id", "ts", ["name", "gate"])
    late = spark.createDataFrame([("LH12", "boarding", "A2", t(3))], SCHEMA)
    out = _by_id(scd2_merge(h, late, "id", "ts", ["name", "gate"]))["LH12"]
    assert [r.name for r in out] == ["scheduled", "airborne"] and out[-1].is_current


def test_merge_is_idempotent(spark):
    upd = spark.createDataFrame([("LH12", "airborne", "A1", t(1)), ("IB5", "scheduled", "E1", t(1))], SCHEMA)
    once = scd2_merge(_first(spark), upd, "id", "ts", ["name", "gate"])
    twice = scd2_merge(once, upd, "id", "ts", ["name", "gate"])
    key = lambda r: (r.id, r.effective_time, r.is_current, r.end_time)
    assert sorted(map(key, once.collect())) == sorted(map(key, twice.collect()))


def _feed(spark):
    # Three batches of snapshots for four keys; one change per key per batch.
    rows = [("1", "A", "F", t(0)), ("2", "B", "M", t(0)), ("3", "C", "M", t(0)),
            ("1", "A", "F", t(10)), ("2", "B2", "M", t(10)), ("4", "D", "F", t(10)),
            ("1", "A1", "F", t(20)), ("2", "B", "M", t(20)), ("3", None, "M", t(20))]
    return spark.createDataFrame(rows, SCHEMA)


def test_history_equals_repeated_merges(spark):
    feed = _feed(spark)
    h = None
    for hour in (0, 10, 20):
        batch = feed.where(F.col("ts") == F.lit(t(hour)).cast("timestamp_ntz"))
        h = scd2_init(batch, "id", "ts") if h is None else scd2_merge(h, batch, "id", "ts", ["name"])
    hist = scd2_history(feed, "id", "ts", ["name"])
    key = lambda r: (r.id, r.name, r.effective_time, r.end_time, r.is_current)
    assert sorted(map(key, h.collect()), key=repr) == sorted(map(key, hist.collect()), key=repr)


def test_history_properties(spark):
    hist = scd2_history(_feed(spark), "id", "ts", ["name"]).collect()
    by = {}
    for r in hist:
        by.setdefault(r.id, []).append(r)
    for versions in by.values():
        assert sum(v.is_current for v in versions) <= 1
        versions.sort(key=lambda v: v.effective_time)
        for a, b in zip(versions, versions[1:]):
            assert a.end_time == b.effective_time  # contiguous, never overlapping


def test_as_of(spark):
    hist = scd2_history(_feed(spark), "id", "ts", ["name"])
    at = scd2_as_of(hist, F.lit(t(15)).cast("timestamp_ntz"))
    got = {r.id: r.name for r in at.collect()}
    assert got == {"1": "A", "2": "B2", "3": "C", "4": "D"}


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_batch = st.lists(st.tuples(st.sampled_from("abcd"), st.sampled_from([None, "x", "y"]), st.integers(0, 3)),
                  min_size=1, max_size=6)


@settings(max_examples=8, deadline=None)
@given(st.lists(_batch, min_size=1, max_size=3))
def test_merge_properties_random(spark, batches):
    hist = None
    for n, rows in enumerate(batches):
        # Each batch is later than the previous one; the minute offset makes duplicates within a batch.
        df = spark.createDataFrame([(k, v, None, t(10 * n) + dt.timedelta(minutes=m)) for k, v, m in rows], SCHEMA)
        hist = scd2_init(df, "id", "ts") if hist is None else scd2_merge(hist, df, "id", "ts", ["name"])
    rows = hist.collect()
    by = {}
    for r in rows:
        by.setdefault(r.id, []).append(r)
    for versions in by.values():
        assert sum(v.is_current for v in versions) == 1
        versions.sort(key=lambda v: v.effective_time)
        for a, b in zip(versions, versions[1:]):
            assert a.end_time == b.effective_time and not a.is_current
            assert a.name != b.name  # a new version only on a (NULL-safe) change
    again = scd2_merge(hist, df, "id", "ts", ["name"])
    assert sorted(map(repr, again.collect())) == sorted(map(repr, rows))
