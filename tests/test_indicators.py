from pyspark.sql import functions as F

from contrail.operators import indicators as I
from contrail.operators.dedup import top_k_per_group
from contrail.plans import queries as Q

SF = "/root/testdata/sf0.001"


def test_in_out_sums(spark):
    cur = Q.current(spark, SF)
    io = I.airport_in_out(cur).agg(F.sum("out_flight_count").alias("o"), F.sum("in_flight_count").alias("i"))
    r = io.collect()[0]
    n = cur.count()
    assert r.o == n and r.i == n


def test_one_sided_airports_get_zero(spark):
    df = spark.createDataFrame([("AAA", "A", "BBB", "B"), ("AAA", "A", "CCC", None), ("DDD", None, "AAA", "A")],
                               "origin_airport_iata string, origin_airport_name string, "
                               "destination_airport_iata string, destination_airport_name string")
    got = {r.airport_iata: (r.airport_name, r.out_flight_count, r.in_flight_count, r.difference)
           for r in I.airport_in_out(df).collect()}
    assert got == {"AAA": ("A", 2, 1, 1), "BBB": ("B", 0, 1, 1), "CCC": (None, 0, 1, 1), "DDD": (None, 1, 0, 1)}


def test_duration_does_not_wrap(spark):
    df = spark.createDataFrame([("z", "L", None), ("x", "L", 90000), ("y", "L", 3600)],
                               "id string, airline_name string, historical_flighttime bigint")
    mart = I.longest_by_time(df)
    assert mart.count() == 3
    rows = I.top_longest_by_time(mart, 3).collect()
    assert [(r.id, r.flighttime_hms) for r in rows] == [("x", "25:00:00"), ("y", "01:00:00"), ("z", None)]


def test_airline_country_is_unique(spark):
    from contrail.operators.dims import airline_country_dim
    supplier = spark.createDataFrame([(1, "S1", 0), (2, "S1", 1), (3, "S2", 9)], "s_suppkey long, s_name string, s_nationkey int")
    nation = spark.createDataFrame([(0, "FRANCE", 0), (1, "BRAZIL", 0)], "n_nationkey int, n_name string, n_regionkey int")
    assert sorted(map(tuple, airline_country_dim(supplier, nation).collect())) == [("S1", "BRAZIL"), ("S2", None)]


def test_regional_flag_by_name_or_code(spark):
    df = spark.createDataFrame([("FR", "C1", "FR", "C2"), (None, "C1", "DE", "C1"), (None, None, None, None),
                                ("FR", None, "DE", None)],
                               "origin_airport_country_name string, origin_airport_country_code string, "
                               "destination_airport_country_name string, destination_airport_country_code string")
    assert [r.regional_flights_active for r in I.regional_flag(df).collect()] == [1, 1, 0, 0]


def test_top_k_per_group_ties(spark):
    df = spark.createDataFrame([("eu", "a", 3), ("eu", "b", 3), ("eu", "c", 1), ("as", "d", 2)],
                               "g string, m string, n int")
    one = top_k_per_group(df, "g", [F.col("n").desc(), F.col("m").asc()], 1).collect()
    assert sorted((r.g, r.m) for r in one) == [("as", "d"), ("eu", "a")]
    ties = top_k_per_group(df, "g", [F.col("n").desc()], 1, ties=True).collect()
    assert sorted((r.g, r.m) for r in ties) == [("as", "d"), ("eu", "a"), ("eu", "b")]


def test_models_count_ignores_null_model(spark):
    df = spark.createDataFrame([("FR", None), ("FR", None), ("FR", "A320")],
                               "origin_airport_country_name string, aircraft_model string")
    got = {r.aircraft_model: r.total_aircraft_model for r in I.models_by_country(df).collect()}
    assert got == {None: 0, "A320": 1}


def test_dedup_has_partial_group_limit(spark):
    from helpers import plan_text
    plan = plan_text(Q.silver(spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_active_set_properties(spark):
    silver = Q.silver(spark, SF)
    assert silver.groupBy("id").count().where("count > 1").count() == 0
    act = Q.active(spark, SF)
    assert act.where("on_ground <> '0' OR status_text LIKE '%Landed%'").count() == 0


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_ap = st.sampled_from(["AAA", "BBB", "CCC", None])


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(_ap, st.sampled_from(["n1", "n2", None]), _ap, st.sampled_from(["m1", None])),
                min_size=1, max_size=30))
def test_in_out_sums_random(spark, flights):
    df = spark.createDataFrame(flights, "origin_airport_iata string, origin_airport_name string, "
                                        "destination_airport_iata string, destination_airport_name string")
    r = I.airport_in_out(df).agg(F.sum("out_flight_count").alias("o"), F.sum("in_flight_count").alias("i"),
                                 F.count(F.lit(1)).alias("n")).collect()[0]
    assert r.o == r.i == len(flights)
    assert r.n == len({f[0] for f in flights} | {f[2] for f in flights})   # one row per code (NULL included)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1000), st.sampled_from([None, 1, 5, 9]), st.sampled_from([None, 2, 6])),
                min_size=1, max_size=25))
def test_current_equals_serving_flag_random(spark, rows):
    import datetime as dt

    from contrail.operators.current import current_flights, with_current_flag
    t0 = dt.datetime(2024, 6, 1)
    data = [(i, None if s is None else t0 + dt.timedelta(hours=s), None if e is None else t0 + dt.timedelta(hours=e))
            for i, s, e in rows]
    df = spark.createDataFrame(data, "id int, scheduled_time_arrival timestamp_ntz, estimated_arrival timestamp_ntz")
    as_of = "2024-06-01 05:00:00"
    a = sorted(r.id for r in current_flights(df, as_of).collect())
    b = sorted(r.id for r in with_current_flag(df, as_of).where("is_current").collect())
    assert a == b
