from pyspark.sql import functions as F

from contrail.operators.clean import clean_flights
from contrail.operators.scd2 import scd2_init, scd2_merge
from contrail.plans import views as V
from contrail.plans.jobs import silver_job
from contrail.session import scratch_path
from contrail.sources.scd2_table import read_scd2
from contrail.sources.sinks import write_run

SF = "/root/testdata/sf0.001"
TRACKED = ["status_text", "on_ground", "estimated_arrival"]


def test_silver_job_two_runs(spark):
    detail = V.detail_view(spark, SF).drop("extract_ts")
    split = F.col("time").cast("bigint") < F.lit(883612800)        # snapshots before / after 1998-01-01
    runs = [(detail.where(split), "1998-01-01 00:00:00"), (detail.where(~split), "2002-01-01 00:00:00")]
    bronze, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    for df, as_of in runs:
        write_run(df, bronze, as_of)
        silver_job(spark, bronze, silver, V.TIME_DETAIL_LEAVES, V.EPOCH_TEXT_COLUMNS, TRACKED,
                   tie_break=["airline_name", "aircraft_model"])
    got = read_scd2(spark, silver)
    mem = None
    for df, _ in runs:
        c = clean_flights(df, time_struct="time_details", leaves=V.TIME_DETAIL_LEAVES,
                          epoch_cols=V.EPOCH_TEXT_COLUMNS)
        mem = (scd2_init(c, "id", "time_updated", ["airline_name", "aircraft_model"]) if mem is None else
               scd2_merge(mem, c, "id", "time_updated", TRACKED, ["airline_name", "aircraft_model"]))
    key = lambda r: (r.id, r.time_updated, r.is_current, r.end_time)
    assert sorted(map(key, got.collect())) == sorted(map(key, mem.collect()))
    assert got.where("is_current").groupBy("id").count().where("count > 1").count() == 0


def test_production_path_marts_from_stored_silver(spark):
    from contrail.operators.dims import airline_country_dim
    from contrail.plans import pipeline as P
    from contrail.plans import queries as Q
    from contrail.sources.sinks import latest_run, read_table
    detail = V.detail_view(spark, SF).drop("extract_ts")
    bronze, silver, marts = (scratch_path(spark, n) for n in ("bronze_p", "silver_p", "marts_p"))
    write_run(detail, bronze, "2002-01-01 00:00:00")
    silver_job(spark, bronze, silver, V.TIME_DETAIL_LEAVES, V.EPOCH_TEXT_COLUMNS, TRACKED,
               tie_break=["airline_name", "aircraft_model"])
    current_part = read_scd2(spark, silver, current_only=True).withColumnRenamed("time_updated", "extract_ts")
    dims = {"continents": Q.continents(spark, SF),
            "airline_countries": airline_country_dim(V.read(spark, SF, "supplier"), V.read(spark, SF, "nation"))}
    names = P.publish_indicators(current_part, Q.AS_OF, marts, dims)
    for n in names:
        assert latest_run(read_table(spark, f"{marts}/{n}")).count() > 0, n


def test_two_ingests_before_one_clean(spark):
    """A clean merges every run that landed since the last one, in order, and only once."""
    from contrail.plans.jobs import unmerged_runs
    detail = V.detail_view(spark, SF).drop("extract_ts")
    bronze, silver = scratch_path(spark, "bronze_two"), scratch_path(spark, "silver_two")
    first = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    write_run(detail.where(first), bronze, "2002-01-01 00:00:00")
    write_run(detail.where(~first), bronze, "2002-01-02 00:00:00")
    assert len(unmerged_runs(spark, bronze, silver)) == 2
    job = lambda: silver_job(spark, bronze, silver, V.TIME_DETAIL_LEAVES, V.EPOCH_TEXT_COLUMNS, TRACKED,
                             tie_break=["airline_name", "aircraft_model"])
    assert job() == 1 and unmerged_runs(spark, bronze, silver) == []
    ids = clean_flights(detail, time_struct="time_details", leaves=V.TIME_DETAIL_LEAVES).select("id").distinct().count()
    assert read_scd2(spark, silver, current_only=True).count() == ids
    assert job() == 1
