import pytest
from pyspark.errors import AnalysisException

from contrail.operators.dims import airline_country_dim
from contrail.plans import pipeline as P
from contrail.plans import queries as Q
from contrail.plans import views as V
from contrail.session import scratch_path
from contrail.sources.sinks import latest_run, read_table

from helpers import plan_text, rows_of

SF = "/root/testdata/sf0.001"


def test_published_marts_equal_queries(spark):
    out = scratch_path(spark, "marts")
    dims = {"continents": Q.continents(spark, SF),
            "airline_countries": airline_country_dim(V.read(spark, SF, "supplier"), V.read(spark, SF, "nation"))}
    silver = Q.silver(spark, SF)
    names = P.publish_indicators(silver, Q.AS_OF, out, dims)
    assert set(names) == set(P.INDICATORS)
    stamps = ["extract_year", "extract_month", "extract_day", "extract_time"]
    pairs = {"current_flight_by_airline": "airline_active_counts", "in_out_flight": "airport_in_out",
             "aircraft_model_by_country": "models_by_country",
             "top3_models_by_airline_country": "top3_models_by_airline_country",
             "top_regional_airline_by_continent": "top_regional_airline_by_continent",
             "longest_flight_by_time": "longest_by_time"}
    for mart, query in pairs.items():
        got = latest_run(read_table(spark, f"{out}/{mart}")).drop(*stamps)
        want = Q.QUERIES[query](spark, SF)
        assert rows_of(got, sorted(want.columns)) == rows_of(want), mart


def test_build_indicators_is_lazy(spark):
    silver = Q.silver(spark, SF)
    got = P.build_indicators(silver, Q.AS_OF, names=["current_flight_by_airline"])
    assert list(got) == ["current_flight_by_airline"]
    assert rows_of(got["current_flight_by_airline"]) == rows_of(Q.QUERIES["airline_active_counts"](spark, SF))


def test_newest_run_of_every_mart(spark):
    out, names = scratch_path(spark, "marts_latest"), ["current_flight_by_airline", "in_out_flight"]
    for as_of in Q.RUN_AS_OF[1:]:
        P.publish_indicators(Q.silver(spark, SF, as_of), as_of, out, names=names)
    marts = P.read_latest_marts(spark, out, names)
    assert list(marts) == names
    for n, df in marts.items():
        assert {(r.extract_year, r.extract_day) for r in df.collect()} == {("1998", "1998_01_02")}
        whole = read_table(spark, f"{out}/{n}")
        assert 0 < df.count() < whole.count()
        assert "PartitionFilters: [isnotnull(extract_time" in plan_text(df)
    with pytest.raises(AnalysisException):
        P.read_latest_marts(spark, out, ["avg_distance_by_country"])
