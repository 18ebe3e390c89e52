from contrail.operators import clean as C
from contrail.operators.nested import explode_flatten, flatten

NESTED = ("id string, icao string, x double, tags array<string>, "
          "time_details struct<scheduled:struct<arrival:string,departure:string>,historical:struct<flighttime:string>>")


def _nested(spark):
    return spark.createDataFrame([
        ("1", "AFR", 1.0, ["a"], (("1700000000", "1699990000"), ("36000",))),
        ("2", "", float("nan"), None, (("", None), ("90000",))),
        ("3", "N/A", None, [], None),
        ("4", None, 2.0, ["b"], (("junk", "1699990000"), (None,))),
    ], NESTED)


def test_blank_normalisation_by_type(spark):
    out = {r.id: r for r in C.normalize_blanks(_nested(spark)).collect()}
    assert out["2"].icao is None and out["3"].icao is None and out["1"].icao == "AFR"
    assert out["2"].x is None and out["4"].x == 2.0
    assert out["3"].tags == [] and out["1"].time_details is not None  # nested types left alone


def test_null_ratios_one_pass(spark):
    got = {r.column_name: r.missing_ratio for r in C.null_ratios(_nested(spark)).collect()}
    assert got == {"id": 0.0, "icao": 0.75, "x": 0.5, "tags": 0.25, "time_details": 0.25}


def test_prune_sparse(spark):
    out = C.prune_sparse(_nested(spark), 0.7)
    assert out.columns == ["id", "x", "tags", "time_details"]
    assert {r.id: r.x for r in out.collect()}["2"] is None            # blanks come back as NULL
    # the share is compared unrounded: 0.7000004 is above 0.7
    near = spark.range(2_500_000).selectExpr("id", "IF(id < 1750001, NULL, 1) AS c")
    assert C.prune_sparse(near, 0.7).columns == ["id"]


def test_huge_epochs_become_null(spark):
    from contrail.functions.timefmt import duration, epoch_to_ts
    df = spark.createDataFrame([("99999999999999999",), ("-99999999999999999",), ("253402300799",), ("x",), ("9223372036854775807",)], "s string")
    assert [None if r.t is None else str(r.t) for r in df.select(epoch_to_ts("s").alias("t")).collect()] == [
        None, None, "9999-12-31 23:59:59", None, None]
    assert [r.d is None for r in df.select(duration("s").alias("d")).where("true").collect()] == [True, True, False, True, True]


def test_flatten_struct_and_epoch(spark):
    leaves = {"scheduled.arrival": "arr", "scheduled.departure": "dep", "historical.flighttime": "ft"}
    out = C.epoch_columns_to_ts(C.flatten_struct(_nested(spark), "time_details", leaves), ["arr", "dep"])
    rows = {r.id: r for r in out.collect()}
    assert "time_details" not in out.columns
    assert str(rows["1"].arr) == "2023-11-14 22:13:20"
    assert rows["2"].arr is None and rows["4"].arr is None       # '' and junk -> NULL, no failure
    assert rows["2"].ft == "90000"


def test_clean_keys(spark):
    df = spark.createDataFrame([("1", "AFR", "CDG", "JFK"), ("2", "N/A", "CDG", "JFK"), ("3", "AFR", None, "JFK"),
                                ("4", "AFR", "", "JFK")],
                               "id string, airline_icao string, origin_airport_iata string, "
                               "destination_airport_iata string")
    assert [r.id for r in C.clean_flights(df).collect()] == ["1"]


def test_detail_record_fields(spark):
    # One nested detail record: aircraft, airline and airports flattened by the generic walker.
    rec = spark.createDataFrame(
        [(("A320", "Airbus A320"), ("Lufthansa", "LH"), (("FRA", "EDDF"), ("LAX", "KLAX")))],
        "aircraft struct<code:string,model:string>, airline struct<name:string,iata:string>, "
        "airport struct<origin:struct<iata:string,icao:string>,destination:struct<iata:string,icao:string>>")
    flat = flatten(flatten(flatten(rec, "aircraft"), "airline"), "airport")
    r = flat.collect()[0]
    assert r.aircraft_code == "A320" and r.airline_name == "Lufthansa" and r.airport_destination_icao == "KLAX"


def test_explode_inner_and_outer(spark):
    df = spark.createDataFrame([(1, [(1, "a"), (2, "b")]), (2, []), (3, None)],
                               "id int, legs array<struct<n:int,s:string>>")
    inner = explode_flatten(df, "legs", position="pos")
    assert sorted((r.id, r.pos, r.legs_n) for r in inner.collect()) == [(1, 0, 1), (1, 1, 2)]
    outer = explode_flatten(df, "legs", outer=True)
    assert sorted(r.id for r in outer.collect()) == [1, 1, 2, 3]
    assert set(outer.columns) == {"id", "legs_n", "legs_s"}
