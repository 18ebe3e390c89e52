"""Named queries over the driver tables: one per operator of the survey.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame built from
the whole tables. Queries marked "writes" go through a written table in the
shared scratch folder and return the rows read back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.geo import register_sql_functions
from contrail.functions.timefmt import ts_literal
from contrail.operators import clean as C
from contrail.operators import indicators as I
from contrail.operators.current import active_flights, current_flights, current_versions, with_current_flag
from contrail.operators.dedup import dedup_latest
from contrail.operators.dims import airline_country_dim, bounded_broadcast, continent_dim, planned_bytes
from contrail.operators.enrich import enrich, enrich_poll, read_enriched, read_pending
from contrail.operators.maintained import MART_COLUMNS, maintain_marts, read_mart
from contrail.operators.nested import explode_flatten
from contrail.operators.profile import merged_ratios, prune_by_profile, update_profiles
from contrail.operators.scd2 import scd2_as_of, scd2_history, scd2_init, scd2_merge, scd2_splice, scd2_timeline, timeline_history
from contrail.plans import views as V
from contrail.plans.jobs import silver_job
from contrail.plans.pipeline import publish_indicators, read_latest_marts
from contrail.session import scratch_path, table_path
from contrail.sources import feeds, sinks
from contrail.sources.compaction import compact_runs, read_runs
from contrail.sources.scd2_table import read_scd2, upsert_scd2
from contrail.streaming import active_counts as S
from contrail.streaming.active_flights import STATE_GROUPS, active_changes, start_active_counts
from contrail.streaming.ingest import BATCH_COLUMN, start_ingest

# Fixed parameters of the registered queries.
AS_OF = "1998-01-01 00:00:00"
RUN_AS_OF = ("1997-12-31 00:00:00", "1998-01-01 00:00:00", "1998-01-02 00:00:00")
SCD_SPLIT = "2024-01-15 00:00:00"
SCD_AS_OF = "2024-01-15 12:00:00"
TOP_K = 10

Query = Callable[[SparkSession, str], DataFrame]


# ---- shared stages -----------------------------------------------------------

def silver(spark, d, as_of=AS_OF) -> DataFrame:
    """Latest snapshot per flight id (W1 over the flight feed) among those taken by ``as_of``."""
    seen = V.flight_view(spark, d, for_sort=True).where(F.col("extract_ts") <= ts_literal(as_of))
    return dedup_latest(seen, "id", V.flight_dedup_order())


def current(spark, d, as_of=AS_OF) -> DataFrame:
    return current_flights(silver(spark, d, as_of), as_of)


def active(spark, d) -> DataFrame:
    return active_flights(current(spark, d))


def continents(spark, d) -> DataFrame:
    return continent_dim(V.read(spark, d, "nation"), V.read(spark, d, "region"))


def _events_scd(spark, d, nullsafe_variant=False):
    ev = V.events(spark, d)
    if nullsafe_variant:
        ev = ev.withColumn("event_type", F.nullif(F.col("event_type"), F.lit("error")))
    split = ts_literal(SCD_SPLIT)
    return ev.where(F.col("ts") < split), ev.where(F.col("ts") >= split)


# ---- sources / sinks ---------------------------------------------------------

def q_scan_filter(spark, d):
    return feeds.read_feed(spark, table_path(d, "lineitem"), schema=V.TABLE_SCHEMAS["lineitem"],
                           where="l_shipdate >= TIMESTAMP_NTZ'1998-01-01 00:00:00' AND l_returnflag = 'R'",
                           columns=["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"])


ORDERS_SCHEMA = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
                 "o_orderdate TIMESTAMP_NTZ")


def q_scan_schema(spark, d):
    return feeds.read_feed(spark, table_path(d, "orders"), schema=ORDERS_SCHEMA)


def _stamped_events(spark, d):
    return feeds.stamp_extract(V.events(spark, d), "ts")


STAMPED_EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
    T.StructField("extract_time", T.LongType()), T.StructField("extract_year", T.StringType()), T.StructField("extract_month", T.StringType()),
    T.StructField("extract_day", T.StringType()),
])


def q_write_partitioned(spark, d):
    """Writes: events partitioned by year/month/day folders, read back under the full schema."""
    path = scratch_path(spark, "write_partitioned")
    sinks.write_table(_stamped_events(spark, d), path, ["extract_year", "extract_month", "extract_day"])
    return sinks.read_table(spark, path, STAMPED_EVENTS_SCHEMA)


def _airline_mart(spark, d, as_of):
    return I.airline_counts(active_flights(current(spark, d, as_of)))


AIRLINE_MART_SCHEMA = T.StructType([
    T.StructField("airline_name", T.StringType()), T.StructField("airline_iata", T.StringType()),
    T.StructField("total_active_flights", T.LongType()),
    T.StructField("extract_year", T.StringType()), T.StructField("extract_month", T.StringType()),
    T.StructField("extract_day", T.StringType()), T.StructField("extract_time", T.LongType()),
])


def q_mart_append(spark, d):
    """Writes: the same run published twice; its folder is replaced, so it is there once."""
    path = scratch_path(spark, "mart_append")
    for _ in range(2):
        sinks.write_run(_airline_mart(spark, d, AS_OF), path, AS_OF)
    return sinks.read_table(spark, path, AIRLINE_MART_SCHEMA)


def q_mart_empty_rerun(spark, d):
    """Writes: two runs, the later one published again with no rows; only the earlier one's rows are left."""
    path = scratch_path(spark, "mart_empty_rerun")
    for as_of in RUN_AS_OF[:2]:
        sinks.write_run(_airline_mart(spark, d, as_of), path, as_of)
    sinks.write_run(_airline_mart(spark, d, RUN_AS_OF[1]).where("airline_name IS NULL AND false"), path, RUN_AS_OF[1])
    return sinks.read_table(spark, path, AIRLINE_MART_SCHEMA)


def _three_runs(spark, d, name):
    path = scratch_path(spark, name)
    for as_of in RUN_AS_OF:
        sinks.write_run(_airline_mart(spark, d, as_of), path, as_of)
    return sinks.latest_run(sinks.read_table(spark, path, AIRLINE_MART_SCHEMA))


def q_mart_latest_run(spark, d):
    """Writes: three runs with rising extraction time; the reader returns the last run."""
    return _three_runs(spark, d, "mart_latest_run")


def q_mart_top3(spark, d):
    """Writes: three runs published to a mart; the reader takes the newest run
    and its top 3 airlines (O6: first rows of a stored mart, ordered explicitly)."""
    return I.top_k(_three_runs(spark, d, "mart_top3"),
                   [F.col("total_active_flights").desc(), F.col("airline_name").asc_nulls_last(),
                    F.col("airline_iata").asc_nulls_last()], 3)


LATEST_MARTS = ("current_flight_by_airline", "regional_flight", "longest_flight_by_time", "longest_flight_by_distance",
                "avg_distance_by_country", "aircraft_company_flight", "aircraft_model_by_country", "in_out_flight")


def q_latest_marts(spark, d):
    """Writes: two runs of every indicator mart; the newest run of each mart is read, with its size and day."""
    out = scratch_path(spark, "latest_marts")
    for as_of in RUN_AS_OF[:2]:
        publish_indicators(silver(spark, d, as_of), as_of, out, names=LATEST_MARTS)
    marts = read_latest_marts(spark, out, LATEST_MARTS)
    sizes = [df.groupBy("extract_day").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("mart"), "extract_day", "n_rows")
             for n, df in marts.items()]
    return reduce(DataFrame.unionByName, sizes)


EVENTS_JSON_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def q_ingest_json(spark, d):
    """Writes: events landed as JSON lines plus a corrupt line, ingested under a
    declared schema; good rows stamped with ``as_of``, the corrupt one quarantined."""
    path = scratch_path(spark, "ingest_json")
    feeds.land_json(V.events(spark, d), path)
    # One truncated record, as a broken API response would leave.
    spark.createDataFrame([('{"event_id": 1, "ts": ',)], "value string").write.mode("append").text(path)
    good, _bad = feeds.ingest_json(spark, path, EVENTS_JSON_SCHEMA, as_of=AS_OF)
    return good


BRONZE_SCHEMA = T.StructType(EVENTS_JSON_SCHEMA.fields + [
    T.StructField("extract_year", T.StringType()), T.StructField("extract_month", T.StringType()),
    T.StructField("extract_day", T.StringType()), T.StructField("extract_time", T.LongType())])


def q_bronze_ingest(spark, d):
    """Writes: one extraction run end to end - landed JSON -> declared schema ->
    stamp -> bronze partitioned by run - run twice (a retry), read back."""
    landing, bronze = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    feeds.land_json(V.events(spark, d), landing)
    for _ in range(2):
        feeds.ingest_to_bronze(spark, landing, EVENTS_JSON_SCHEMA, bronze, AS_OF)
    return sinks.read_table(spark, bronze, BRONZE_SCHEMA)


def q_stream_ingest(spark, d):
    """Writes: events land as JSON lines in two drops with a broken line; after each drop one stream feeds bronze and the
    quarantine, three files a batch, and once more with nothing new; bronze is read back."""
    landing, bronze, ckpt = (scratch_path(spark, n) for n in ("landing_s", "bronze_s", "ingest_ckpt"))
    first = F.col("event_id") % 4 != 0
    for drop in (first, ~first, None):
        if drop is not None:
            feeds.land_json(V.events(spark, d).where(drop).repartition(4), landing)
            spark.createDataFrame([('{"event_id": 1, "ts": ',)], "value string").write.mode("append").text(landing)
        start_ingest(spark, landing, EVENTS_JSON_SCHEMA, bronze, ckpt, AS_OF, max_files_per_trigger=3).awaitTermination()
    schema = T.StructType([*BRONZE_SCHEMA.fields, T.StructField(BATCH_COLUMN, T.StringType())])
    return sinks.read_table(spark, bronze, schema).drop(BATCH_COLUMN)


STAMP_FIELDS = BRONZE_SCHEMA.fields[-4:]


def _ingested(spark, d, name, feed):
    """Land a feed as JSON, ingest it under its declared schema in two runs, read bronze back."""
    landing, bronze = scratch_path(spark, f"land_{name}"), scratch_path(spark, f"bronze_{name}")
    schema = feeds.feed_schema(name)
    feeds.land_json(feed, landing)
    for as_of in (AS_OF, RUN_AS_OF[2]):            # the second run finds no new file
        feeds.ingest_to_bronze(spark, landing, schema, bronze, as_of)
    return sinks.read_table(spark, bronze, T.StructType([*schema.fields, *STAMP_FIELDS]))


def q_ingest_flight(spark, d):
    """Writes: the position feed ingested into bronze."""
    return _ingested(spark, d, "flight", V.position_feed(spark, d))


def q_ingest_airline(spark, d):
    """Writes: the airline feed ingested into bronze."""
    return _ingested(spark, d, "airline", V.airline_feed(spark, d))


def q_ingest_airport(spark, d):
    """Writes: the airport feed ingested into bronze."""
    return _ingested(spark, d, "airport", V.airport_feed(spark, d))


def q_ingest_detail(spark, d):
    """Writes: summaries matched with their details (S8), stamped, as a bronze run."""
    path = scratch_path(spark, "bronze_enriched")
    matched = q_enrich_detail(spark, d)
    sinks.write_run(matched, path, AS_OF)
    return sinks.read_table(spark, path, T.StructType([*matched.schema.fields, *STAMP_FIELDS]))


def _detail_bronze(spark, d) -> str:
    """Land the detail feed with broken records among it and ingest it under its 63 declared fields."""
    landing, bronze = scratch_path(spark, "land_detail"), scratch_path(spark, "bronze_landed_detail")
    feeds.land_json(V.detail_feed(spark, d), landing)
    line, rec = F.col("l_linenumber"), F.concat(F.lit('{"id": "'), F.col("l_orderkey").cast("string"), F.lit('", '))
    broken = (F.when(line == 7, F.concat(rec, F.lit('"time_details": "n/a"}')))
              .when(line == 6, F.concat(rec, F.lit('"trail": {"lat": "1"}}')))
              .when(line == 5, F.concat(rec, F.lit('"trail": 1, "aircraft_history": ["x"]}')))
              .when(line == 4, F.concat(rec, F.lit('"time_details": {'))))
    V.read(spark, d, "lineitem").where(line >= 4).select(broken.alias("value")).write.mode("append").text(landing)
    feeds.ingest_to_bronze(spark, landing, feeds.feed_schema("detail"), bronze, AS_OF)
    return bronze


def q_ingest_detail_feed(spark, d):
    """Writes: the nested detail feed from landed JSON into bronze (S6, S9, S13), read back with leaves of its struct and arrays."""
    schema = T.StructType([*feeds.feed_schema("detail").fields, *STAMP_FIELDS])
    return sinks.read_table(spark, _detail_bronze(spark, d), schema).select(
        "id", "airline_icao", "status_text", "origin_airport_timezone_name",
        # The size of one leaf's array is the array's, and Parquet reads no other leaf for it.
        F.col("time_details.real.departure").alias("real_departure"), F.array_size("aircraft_history.airport.origin.code.iata").alias("n_legs"),
        F.get(F.col("aircraft_history.airport.origin.code.iata"), F.lit(0)).alias("first_leg_origin"),
        F.array_size("trail.ts").alias("n_fixes"), F.get(F.col("trail.ts"), F.lit(1)).alias("last_fix_ts"),
        *[f.name for f in STAMP_FIELDS])


def q_ingest_detail_quarantine(spark, d):
    """Writes: the broken records of the same ingest, counted by the fields that did not parse."""
    bad = spark.read.parquet(f"{_detail_bronze(spark, d)}/_quarantine")
    return (bad.groupBy(F.array_join(F.array_sort(feeds.FAILED_COLUMN), ",").alias("failed_fields"))
            .agg(F.count(F.lit(1)).alias("n_records")))


def q_detail_to_silver(spark, d):
    """Writes: landed detail JSON through bronze and the cleaning job into the stored silver history, read back."""
    bronze, path = _detail_bronze(spark, d), scratch_path(spark, "silver_landed")
    silver_job(spark, bronze, path, V.TIME_DETAIL_LEAVES, V.EPOCH_TEXT_COLUMNS, ["status_text"], tie_break=SILVER_TIE_BREAK)
    return read_scd2(spark, path).select(*SILVER_COLUMNS, "is_current", "effective_time", "end_time")


POINT_IDS = ("1-1", "7-2", "30-3", "100-1", "500-4", "1123-7", "1499-2", "no such flight")


def q_scan_by_id(spark, d):
    """Writes: the position feed sorted by id with bloom filters in files over all ids; a few flights are read by id."""
    path = scratch_path(spark, "indexed")
    sinks.write_indexed(V.position_feed(spark, d, for_sort=True), path, "id")
    return feeds.read_feed(spark, path, feeds.feed_schema("flight"), where=f"id IN {POINT_IDS}",
                           columns=["id", "callsign", "time", "latitude", "longitude", "on_ground"])


def q_compacted_runs(spark, d):
    """Writes: events as one run for each hour of a day, the first 20 packed into a few files, in two goes (S3, S4, S10);
    all runs are read back."""
    path = scratch_path(spark, "hourly")
    hour = F.to_timestamp_ntz(F.concat(F.lit("1998-01-01 "), F.date_format("ts", "HH"), F.lit(":00:00")))
    runs = feeds.stamp_extract(V.events(spark, d).withColumn("at", hour), "at").drop("at")
    sinks.write_table(runs, path, sinks.RUN_PARTITIONS)
    day = int(sinks.run_folder("", "1998-01-01 00:00:00").rpartition("=")[2])
    for hours in (12, 20):
        compact_runs(spark, path, day + hours * 3600, BRONZE_SCHEMA)
    return read_runs(spark, path, BRONZE_SCHEMA)


def q_enrich_detail(spark, d):
    matched, _ = enrich(V.read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"),
                        V.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"),
                        "o_orderkey", "l_orderkey")
    return matched


def q_enrich_detail_missing(spark, d):
    _, missing = enrich(V.read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"),
                        V.read(spark, d, "lineitem").select("l_orderkey"), "o_orderkey", "l_orderkey")
    return missing


def _enrich_polls(spark, d) -> str:
    """Two polls: each brings half of the orders, and the details of every third order come with the second only."""
    path = scratch_path(spark, "enrich_polls")
    orders = V.read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = V.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    early, late = F.col("l_orderkey") % 3 != 0, F.col("l_orderkey") % 3 == 0
    odd, even = F.col("o_orderkey") % 2 == 1, F.col("o_orderkey") % 2 == 0
    polls = ((odd, early), (even, late | (F.col("l_orderkey") % 2 == 0)))
    for i, (summaries, details) in enumerate((*polls, polls[1])):          # the second poll is repeated
        enrich_poll(spark, path, orders.where(summaries), lines.where(details), "o_orderkey", "l_orderkey", min(i, 1))
    return path


def q_enrich_late(spark, d):
    """Writes: details that come one poll late still meet their summaries (S8); the enriched rows are read back."""
    return read_enriched(spark, _enrich_polls(spark, d))


def q_enrich_pending(spark, d):
    """Writes: the summaries that wait for their detail after both polls."""
    return read_pending(spark, _enrich_polls(spark, d)).select("o_orderkey", "o_custkey", "o_orderstatus", "polls_waited")


def q_extract_stamp(spark, d):
    return feeds.stamp_extract(V.flight_view(spark, d).select("id", "extract_ts"), "extract_ts")


# ---- projections / filters / cleaning ----------------------------------------

KEY_COLS = ["id", "airline_icao", "origin_airport_iata", "destination_airport_iata"]


def q_clean_drop_null_keys(spark, d):
    return C.drop_null_keys(V.flight_view(spark, d)).select(*KEY_COLS)


def q_clean_drop_sentinels(spark, d):
    return C.drop_sentinel_keys(V.flight_view(spark, d)).select(*KEY_COLS)


def q_flatten_struct(spark, d):
    out = C.flatten_struct(V.detail_view(spark, d), "time_details", V.TIME_DETAIL_LEAVES)
    return out.select("id", *V.TIME_DETAIL_LEAVES.values())


def q_epoch_to_ts(spark, d):
    out = C.flatten_struct(V.detail_view(spark, d), "time_details", V.TIME_DETAIL_LEAVES)
    return C.epoch_columns_to_ts(out, V.EPOCH_TEXT_COLUMNS).select("id", *V.EPOCH_TEXT_COLUMNS)


def q_clean_flights(spark, d):
    return C.clean_flights(V.detail_view(spark, d), time_struct="time_details", leaves=V.TIME_DETAIL_LEAVES,
                           epoch_cols=V.EPOCH_TEXT_COLUMNS)


def q_blank_to_null(spark, d):
    return C.normalize_blanks(V.flight_view(spark, d))


def q_null_ratio_profile(spark, d):
    return C.null_ratios(V.detail_view(spark, d))


def q_prune_sparse_columns(spark, d):
    """All columns profiled, nested ones included; those that stay nested are shown as present or not."""
    out = C.prune_sparse(V.detail_view(spark, d), 0.7)
    nested = {f.name: F.col(f.name).isNotNull().alias(f"has_{f.name}")
              for f in out.schema.fields if isinstance(f.dataType, (T.StructType, T.ArrayType))}
    return out.select(*[nested.get(c, F.col(c)) for c in out.columns])


def _profiled_runs(spark, d) -> tuple[str, str]:
    """The flight feed as three bronze runs, profiled as they come; (bronze, profiles)."""
    bronze, profiles = scratch_path(spark, "bronze_profiled"), scratch_path(spark, "profiles")
    feed = V.flight_view(spark, d)
    part = F.pmod(F.xxhash64("id"), F.lit(3))
    for i, as_of in enumerate(RUN_AS_OF):
        sinks.write_run(feed.where(part == i), bronze, as_of)
        update_profiles(spark, bronze, profiles)
    return bronze, profiles


def q_profile_from_runs(spark, d):
    """Writes: three runs, each profiled when it came; the share of missing values over all of them from the sums."""
    _, profiles = _profiled_runs(spark, d)
    return merged_ratios(spark, profiles).withColumn("missing_ratio", F.round("missing_ratio", 6))


def q_prune_from_profiles(spark, d):
    """Writes: the runs pruned of columns over a fifth missing, decided by the stored profiles."""
    bronze, profiles = _profiled_runs(spark, d)
    feed = sinks.read_table(spark, bronze).drop(*sinks.RUN_PARTITIONS)
    return prune_by_profile(feed, merged_ratios(spark, profiles), 0.2)


# Fixed order among snapshots of one flight and time: every column the silver query shows.
SILVER_COLUMNS = ["id", "airline_icao", "origin_airport_iata", "destination_airport_iata", "status_text", "on_ground",
                  "time_updated"]
SILVER_TIE_BREAK = ["status_text", "on_ground", "airline_icao", "origin_airport_iata", "destination_airport_iata"]


def q_clean_to_silver(spark, d):
    """Writes: the detail feed as two bronze runs, then one cleaning job over every run
    not yet merged (twice: the second finds none), into the stored silver history; read back."""
    bronze, path = scratch_path(spark, "bronze_detail"), scratch_path(spark, "silver")
    detail = V.detail_view(spark, d).drop("extract_ts")
    first = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    for part, as_of in ((first, RUN_AS_OF[0]), (~first, RUN_AS_OF[1])):
        sinks.write_run(detail.where(part), bronze, as_of)
    for _ in range(2):
        silver_job(spark, bronze, path, V.TIME_DETAIL_LEAVES, V.EPOCH_TEXT_COLUMNS, ["status_text"],
                   tie_break=SILVER_TIE_BREAK)
    return read_scd2(spark, path).select(*SILVER_COLUMNS, "is_current", "effective_time", "end_time")


def q_current_flights(spark, d):
    return current(spark, d)


def q_active_flights(spark, d):
    return active(spark, d)


def q_dedup_latest(spark, d):
    return silver(spark, d)


def q_regional_flag(spark, d):
    return I.regional_flag(active(spark, d)).select("id", "regional_flights_active")


def q_route_distance(spark, d):
    return I.route_distance(active(spark, d)).select(
        "id", F.round("distance_km", I.ROUND_DIGITS).alias("distance_km"))


def q_route_distance_sql(spark, d):
    """The same route distance through the SQL API (U1): ``haversine_km`` is a SQL
    function that the analyzer inlines, so the plan equals the DataFrame one."""
    register_sql_functions(spark)
    active(spark, d).createOrReplaceTempView("contrail_active_flights")
    return spark.sql("""
        SELECT id, round(haversine_km(try_cast(origin_airport_latitude AS DOUBLE),
                                      try_cast(origin_airport_longitude AS DOUBLE),
                                      try_cast(destination_airport_latitude AS DOUBLE),
                                      try_cast(destination_airport_longitude AS DOUBLE)), 6) AS distance_km
        FROM contrail_active_flights""")


def q_serving_current(spark, d):
    """Writes: the cleaned table with ``is_current`` against two rising ``as_of`` (D8);
    the second refresh replaces the first as a whole. Both see the snapshots taken by the second."""
    path = scratch_path(spark, "serving_current")
    for as_of in RUN_AS_OF[:2]:
        table = with_current_flag(silver(spark, d), as_of)
        sinks.write_version(table, path, partition_by="is_current")
    return sinks.read_version(spark, path, table.schema)


# ---- nested ------------------------------------------------------------------

def q_explode_history(spark, d):
    legs = explode_flatten(V.detail_view(spark, d).selectExpr("id AS current_id", "aircraft_model",
                                                              "aircraft_history"),
                           "aircraft_history", prefix="leg", position="leg_pos")
    return legs.select("current_id", "aircraft_model", "leg_pos", F.col("leg_identification_id").alias("leg_id"))


def q_flatten_history(spark, d):
    src = V.detail_view(spark, d).selectExpr("id AS current_id", "aircraft_history")
    return explode_flatten(src, "aircraft_history", prefix="aircraft")


def q_history_mart(spark, d):
    """Writes: past legs flattened to their 41 leaves with the flight they belong to, as one run of a mart."""
    path = scratch_path(spark, "history_mart")
    legs = explode_flatten(V.detail_view(spark, d).selectExpr("id AS current_id", "aircraft_model", "aircraft_history"),
                           "aircraft_history", prefix="aircraft")
    sinks.write_run(legs, path, AS_OF)
    return sinks.read_table(spark, path, T.StructType([*legs.schema.fields, *STAMP_FIELDS]))


# ---- aggregates and indicators -----------------------------------------------

def q_airline_active_counts(spark, d):
    return I.airline_counts(active(spark, d))


def q_top_airline(spark, d):
    return I.top_k(I.airline_counts(active(spark, d)),
                   [F.col("total_active_flights").desc(), F.col("airline_name").asc_nulls_last(),
                    F.col("airline_iata").asc_nulls_last()], 1)


def q_regional_by_country_airline(spark, d):
    return I.regional_counts(active(spark, d))


def q_avg_distance_by_country(spark, d):
    return I.avg_distance(I.route_distance(active(spark, d)),
                          [F.col("origin_airport_country_name").alias("country"),
                           F.col("origin_airport_country_code").alias("country_code")])


def q_manufacturer_counts(spark, d):
    return I.manufacturer_counts(active(spark, d))


def q_top_manufacturer(spark, d):
    return I.top_k(I.manufacturer_counts(active(spark, d)),
                   [F.col("total_active_flights").desc(), F.col("aircraft_manufacturer").asc_nulls_last()], 1)


def q_models_by_country(spark, d):
    return I.models_by_country(current(spark, d))


def q_airport_outbound(spark, d):
    return I.airport_outbound(current(spark, d))


def q_airport_inbound(spark, d):
    return I.airport_inbound(current(spark, d))


def q_airport_in_out(spark, d):
    return I.airport_in_out(current(spark, d))


def q_airport_max_imbalance(spark, d):
    return I.top_k(I.airport_in_out(current(spark, d)),
                   [F.col("difference").desc(), F.col("airport_iata").asc_nulls_last()], 1)


def q_longest_by_time(spark, d):
    return I.longest_by_time(active(spark, d))


def q_top_longest_by_time(spark, d):
    return I.top_longest_by_time(I.longest_by_time(active(spark, d)), TOP_K)


def q_longest_by_distance(spark, d):
    return I.longest_by_distance(I.route_distance(active(spark, d)))


def q_top_longest_by_distance(spark, d):
    return I.top_longest_by_distance(I.longest_by_distance(I.route_distance(active(spark, d))), TOP_K)


def q_top_regional_airline_by_continent(spark, d):
    return I.top_regional_airline_by_continent(active(spark, d), continents(spark, d))


def q_avg_distance_by_continent(spark, d):
    return I.avg_distance_by_continent(I.route_distance(active(spark, d)), continents(spark, d))


def _zoned(spark, d, rows) -> tuple[DataFrame, dict]:
    """Rows with the origin's time zone, and what the continents need when only two countries of three are known."""
    zones = V.nation_zones(spark, d)
    zoned = zones.select(F.col("country").alias("origin_airport_country_name"), F.col("zone").alias("origin_airport_timezone_name"))
    nation = V.read(spark, d, "nation")
    known = continent_dim(nation.where("n_nationkey % 3 <> 0"), V.read(spark, d, "region"))
    return (rows.join(bounded_broadcast(zoned, bound_by=nation), "origin_airport_country_name", "left"),
            {"continents": known, "zone_prefixes": V.zone_prefixes(spark, d), "zones": zones.select("zone")})


def q_top_regional_airline_by_zone(spark, d):
    rows, dims = _zoned(spark, d, active(spark, d))
    return I.top_regional_airline_by_continent(rows, **dims)


def q_avg_distance_by_zone(spark, d):
    rows, dims = _zoned(spark, d, active(spark, d))
    return I.avg_distance_by_continent(I.route_distance(rows), **dims)


def _airline_countries(spark, d):
    return airline_country_dim(V.read(spark, d, "supplier"), V.read(spark, d, "nation"))


def q_top3_models_by_airline_country(spark, d):
    return I.top_models_by_airline_country(current(spark, d), _airline_countries(spark, d), 3)


def q_flown_distance(spark, d):
    return I.flown_distance(active(spark, d))


def q_flown_time(spark, d):
    """Over the cleaned detail feed, which has the real departure."""
    clean = C.clean_flights(V.detail_view(spark, d, for_sort=True), time_struct="time_details", leaves=V.TIME_DETAIL_LEAVES,
                            epoch_cols=V.EPOCH_TEXT_COLUMNS).where(F.col("extract_ts") <= ts_literal(AS_OF))
    latest = dedup_latest(clean, "id", V.flight_dedup_order())
    return I.flown_time(active_flights(current_flights(latest, AS_OF)))


def q_trail_distance(spark, d):
    """Path length per user over the ordered fixes (D4); fixes derived from events."""
    ev = V.events(spark, d).select(
        "user_id", "ts", "event_id",
        ((F.col("event_id") * 7) % 120 - 60).cast("double").alias("lat"),
        ((F.col("event_id") * 37) % 360 - 180).cast("double").alias("lng"))
    return I.trail_distance(ev, "user_id", "ts", "lat", "lng", tie_break=["event_id"])


# ---- SCD2 --------------------------------------------------------------------

def q_scd2_first_load(spark, d):
    return scd2_init(V.events(spark, d), "user_id", "ts", tie_break=["event_id"])


def _merged(spark, d, nullsafe_variant=False):
    base, updates = _events_scd(spark, d, nullsafe_variant)
    hist = scd2_init(base, "user_id", "ts", tie_break=["event_id"])
    return scd2_merge(hist, updates, "user_id", "ts", ["event_type"], tie_break=["event_id"], nullsafe=True)


def q_scd2_merge(spark, d):
    return _merged(spark, d)


def q_scd2_merge_nullsafe(spark, d):
    return _merged(spark, d, nullsafe_variant=True)


def q_scd2_stored_merge(spark, d):
    """Writes: the same two batches merged through the stored Parquet history
    (first load, then one upsert that reads only the current part), read back."""
    base, updates = _events_scd(spark, d)
    path = scratch_path(spark, "scd2_stored")
    upsert_scd2(spark, path, base, "user_id", "ts", ["event_type"], tie_break=["event_id"])
    upsert_scd2(spark, path, updates, "user_id", "ts", ["event_type"], tie_break=["event_id"])
    return read_scd2(spark, path)


def _dirty_events(spark, d):
    """Events with NULL keys and NULL times, dealt over two batches whose times overlap."""
    ev = V.events(spark, d).withColumns({
        "ts": F.when(F.col("event_id") % 11 != 0, F.col("ts")),
        "user_id": F.when(F.col("user_id") % 13 != 0, F.col("user_id"))})
    late = F.col("event_id") % 3 == 0
    return ev.where(~late), ev.where(late)


def q_scd2_merge_dirty(spark, d):
    base, updates = _dirty_events(spark, d)
    hist = scd2_init(base, "user_id", "ts", tie_break=["event_id"])
    return scd2_merge(hist, updates, "user_id", "ts", ["event_type"], tie_break=["event_id"])


def q_scd2_stored_dirty(spark, d):
    """Writes: the dirty batches merged through the stored history, read back."""
    path = scratch_path(spark, "scd2_dirty")
    for part in _dirty_events(spark, d):
        upsert_scd2(spark, path, part, "user_id", "ts", ["event_type"], tie_break=["event_id"])
    return read_scd2(spark, path)


def q_scd2_stored_current(spark, d):
    """Writes: the stored history after two batches; its current part read through partition pruning."""
    path = scratch_path(spark, "scd2_current")
    for part in _events_scd(spark, d):
        upsert_scd2(spark, path, part, "user_id", "ts", ["event_type"], tie_break=["event_id"])
    return read_scd2(spark, path, current_only=True)


def q_scd2_current_view(spark, d):
    return current_versions(_merged(spark, d))


def _history(spark, d):
    return scd2_history(V.events(spark, d), "user_id", "ts", ["event_type"], tie_break=["event_id"])


def q_scd2_history(spark, d):
    return _history(spark, d)


def q_scd2_splice(spark, d):
    """Writes: events dealt over three batches in no order of time, the last with replays of the first; each is
    spliced into the stored timeline, and the history of the whole feed is read back (C3)."""
    ev, timeline = V.events(spark, d), None
    batches = [ev.where(F.col("event_id") % 3 == i) for i in (2, 0)] + [ev.where(F.col("event_id") % 3 != 0)]
    for late in batches:
        if timeline is None:
            parts = [scd2_timeline(late, "user_id", "ts", ["event_type"], ["event_id"])]
        else:
            parts = scd2_splice(timeline, late, "user_id", "ts", ["event_type"], ["event_id"])
        path = scratch_path(spark, "scd2_timeline")
        for part in parts:
            sinks.write_table(part, path)
        timeline = spark.read.schema(parts[0].schema).parquet(path)
    return timeline_history(timeline)


def q_scd2_as_of(spark, d):
    return scd2_as_of(_history(spark, d), ts_literal(SCD_AS_OF))


# ---- streaming ---------------------------------------------------------------

def q_stream_active_counts(spark, d):
    """Writes: events as a file stream, one-day tumbling windows per event type,
    drained with ``availableNow`` into a foreachBatch sink and read back."""
    schema = V.events(spark, d).schema
    out, ckpt = scratch_path(spark, "stream_counts"), scratch_path(spark, "stream_ckpt")
    stream = S.file_stream(spark, table_path(d, "events"), schema)
    counts = S.windowed_counts(stream, "ts", ["event_type"], "1 day", "2 days", dedup_keys=["event_id"])
    q = S.start_window_counts(counts, out, ckpt)
    q.awaitTermination()
    return S.read_window_counts(spark, out, ["window_start", "event_type"])


# When the flights of the first poll are seen again, some landed, some under another airline.
SEEN_AGAIN = "1997-12-31 18:00:00"
SNAPSHOT_COLUMNS = ["id", "extract_ts", "airline_name", "airline_iata", "on_ground", "status_text", "estimated_arrival",
                    "scheduled_time_arrival"]


def _polls(spark, d, columns=SNAPSHOT_COLUMNS) -> list[DataFrame]:
    """Two polls of the feed, one snapshot per flight and time: the second has new flights and some of the first again."""
    # Written once: the flights seen again are taken from it, and it is not derived anew for them.
    seen, path = silver(spark, d, RUN_AS_OF[0]).select(*columns), scratch_path(spark, "first_poll")
    sinks.write_table(seen, path)
    first = sinks.read_table(spark, path, seen.schema)
    order = F.split_part("id", F.lit("-"), F.lit(1)).cast("bigint")
    landed, moved = order % 5 == 0, order % 7 == 1
    again = first.where(landed | moved).withColumns({
        "extract_ts": ts_literal(SEEN_AGAIN),
        "status_text": F.when(landed, F.lit("Landed 12:00")).otherwise(F.col("status_text")),
        "airline_name": F.when(moved, F.lit("Moved")).otherwise(F.col("airline_name")),
        "airline_iata": F.when(moved, F.lit("M1")).otherwise(F.col("airline_iata"))})
    new = V.flight_view(spark, d, for_sort=True).where((F.col("extract_ts") > ts_literal(RUN_AS_OF[0])) & (F.col("extract_ts") <= ts_literal(AS_OF)))
    return [first, dedup_latest(new, "id", V.flight_dedup_order()).select(*columns).unionByName(again)]


# Bytes of the line items for each group of flights, which Python holds whole: some two hundred thousand snapshots at most.
STATE_GROUP_BYTES = 4 << 20


def q_stream_active_flights(spark, d):
    """Writes: two polls land one after the other; after each the stream is drained from the same checkpoint. State
    of each flight takes counts back as flights land, change airline or pass their arrival; the totals are read back."""
    land, out, ckpt = (scratch_path(spark, n) for n in ("polls", "active_counts", "active_ckpt"))
    groups = ["airline_name", "airline_iata"]
    state_groups = max(STATE_GROUPS, -(-planned_bytes(V.read(spark, d, "lineitem")) // STATE_GROUP_BYTES))
    for poll in _polls(spark, d):
        sinks.write_table(poll, land)
        stream = S.file_stream(spark, land, poll.schema)
        changes = active_changes(stream, "id", "extract_ts", groups, state_groups=state_groups)
        start_active_counts(changes, groups, out, ckpt).awaitTermination()
    return sinks.read_version(spark, out).select(*groups, F.col("n").alias("total_active_flights"))


# When a third poll sees some flights of the first once more.
SEEN_LAST = "1998-01-01 18:00:00"


def _three_batches(spark, d) -> list[DataFrame]:
    polls = _polls(spark, d, ["id", "extract_ts", *MART_COLUMNS])
    once_more = polls[0].where(F.split_part("id", F.lit("-"), F.lit(1)).cast("bigint") % 11 == 0).withColumns({
        "extract_ts": ts_literal(SEEN_LAST), "status_text": F.lit("Scheduled"), "aircraft_model": F.lit("GLIDER one")})
    return [*polls, once_more]


# How the marts kept from changes are shown in one table: up to four group columns as text, a count and a number.
_SHOWN = {
    "current_flight_by_airline": (["airline_name", "airline_iata"], "total_active_flights", None),
    "regional_flight": (["country", "country_code", "airline_name", "airline_iata"], "total_regional_flights", None),
    "avg_distance_by_country": (["country", "country_code"], None, "average_flight_length_km"),
    "aircraft_company_flight": (["aircraft_manufacturer"], "total_active_flights", None),
    "aircraft_model_by_country": (["country", "aircraft_model"], "total_aircraft_model", None),
    "in_out_flight": (["airport_iata", "airport_name"], "out_flight_count", "in_flight_count"),
}


def show_marts(read) -> DataFrame:
    """All marts in one table, each got by ``read(name)``."""
    parts = []
    for name, (groups, count, number) in _SHOWN.items():
        m = read(name)
        g = [F.col(groups[i]) if i < len(groups) else F.lit(None).cast("string") for i in range(4)]
        parts.append(m.select(F.lit(name).alias("mart"), *(c.alias(f"g{i + 1}") for i, c in enumerate(g)),
                              (F.col(count) if count else F.lit(None)).cast("bigint").alias("flights"),
                              (F.col(number) if number else F.lit(None)).cast("double").alias("number")))
    return reduce(DataFrame.unionByName, parts)


def q_marts_from_changes(spark, d):
    """Writes: three batches merged into stored silver; after each, six marts take what the batch opened and closed
    (I1, I2, I4-I7); shown in one table."""
    path, out = scratch_path(spark, "silver_marts"), scratch_path(spark, "kept_marts")
    for batch in _three_batches(spark, d):
        upsert_scd2(spark, path, batch, "id", "extract_ts", MART_COLUMNS, tie_break=["status_text"])
        maintain_marts(spark, path, out)
    return show_marts(lambda name: read_mart(spark, out, name))


def q_stream_scd2_merge(spark, d):
    """Writes: the change feed lands in two drops (before / after the split);
    after each drop the stream is drained with ``availableNow`` from the same
    checkpoint, merging each micro-batch into the stored SCD2 history
    (foreachBatch). Landing the second drop only after the first is merged
    fixes the order, as an hourly poll would. The history is read back."""
    base, updates = _events_scd(spark, d)
    land, table, ckpt = (scratch_path(spark, n) for n in ("scd_land", "scd_table", "scd_ckpt"))
    schema = V.events(spark, d).schema
    for part in (base, updates):
        sinks.write_table(part, land)
        stream = S.file_stream(spark, land, schema)
        S.start_scd2_stream(stream, table, "user_id", "ts", ["event_type"], ckpt, tie_break=["event_id"]) \
            .awaitTermination()
    return read_scd2(spark, table)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
