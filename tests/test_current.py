import datetime as dt

from contrail.operators.current import active_flights, current_flights, with_current_flag

AS_OF = "2024-06-01 12:00:00"
NOW = dt.datetime(2024, 6, 1, 12)
PAST, FUTURE = NOW - dt.timedelta(hours=3), NOW + dt.timedelta(hours=3)

# id, scheduled arrival, estimated arrival
ROWS = [
    (1, PAST, PAST),
    (2, FUTURE, PAST),       # estimated wins: already arrived
    (3, PAST, None),         # no estimate: scheduled in the past
    (4, FUTURE, None),
    (5, PAST, FUTURE),       # estimated wins: still flying
    (6, FUTURE, FUTURE),
    (7, None, PAST),
    (8, None, None),         # unknown arrival counts as current
]
SCHEMA = "id int, scheduled_time_arrival timestamp_ntz, estimated_arrival timestamp_ntz"


def test_current_truth_table(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    rows = current_flights(df, AS_OF).collect()
    assert {r.id for r in rows} == {4, 5, 6, 8}
    assert all(r.is_current is True and r.end_time is None for r in rows)


def test_session_zone_does_not_matter(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        ids = {r.id for r in current_flights(df, AS_OF).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert ids == {4, 5, 6, 8}


def test_serving_flag_keeps_all_rows(spark):
    df = with_current_flag(spark.createDataFrame(ROWS, SCHEMA), AS_OF)
    rows = {r.id: r for r in df.collect()}
    assert len(rows) == 8
    assert rows[1].is_current is False and rows[1].end_time == NOW
    assert rows[8].is_current is True and rows[8].end_time is None


def test_active_filter(spark):
    df = spark.createDataFrame(
        [(1, "0", "Estimated 11:00"), (2, "1", "Estimated"), (3, "0", "Landed 10:00"), (4, "0", None),
         (5, "N/A", "Scheduled"), (6, "0", "Scheduled")],
        "id int, on_ground string, status_text string")
    assert {r.id for r in active_flights(df).collect()} == {1, 6}


def test_epoch_fields_are_zone_free(spark):
    from pyspark.sql import functions as F

    from contrail.functions.timefmt import epoch_micros, epoch_seconds, epoch_to_ts
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles", "Europe/Paris"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([("1998-04-05 02:30:00.250000",), ("1969-12-31 23:59:59",)], "s string")
            df = df.select(F.col("s").cast("timestamp_ntz").alias("t"))
            r = df.select(epoch_seconds("t").alias("e"), epoch_micros("t").alias("m"),
                          epoch_to_ts(epoch_seconds("t")).alias("back")).collect()
            assert [x.e for x in r] == [891743400, -1]
            assert r[0].m == 891743400_250000
            assert str(r[0].back) == "1998-04-05 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
