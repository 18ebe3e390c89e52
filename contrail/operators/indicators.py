"""The flight indicators (I1-I7, D1-D6) as DataFrame -> DataFrame functions.

All aggregates are plain ``groupBy().agg()`` so Spark combines map-side
before the shuffle: a hot airline, airport or country costs one partial row
per map task, not its whole group in one reducer. Top-k uses ``orderBy``
+ ``limit`` (``TakeOrderedAndProject``: per-task top-k, then a merge of k rows
per task) and ranks per group use ``row_number`` (planned with a partial
``WindowGroupLimit`` on the aggregated rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.geo import haversine_km
from contrail.functions.timefmt import epoch_seconds
from contrail.operators.dedup import top_k_per_group
from contrail.operators.dims import bounded_broadcast, join_dimension, zone_continents
from contrail.operators.sequence import with_neighbor

# Decimal places kept for floating averages and distances in outputs.
ROUND_DIGITS = 6


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Global top-k (O1, O4, O5): the sort order must be total for a stable answer."""
    return df.orderBy(*order).limit(k)


def airline_counts(active: DataFrame) -> DataFrame:
    """Active flights per airline (A1)."""
    return active.groupBy("airline_name", "airline_iata").agg(F.count(F.lit(1)).alias("total_active_flights"))


def regional_flag(df: DataFrame, out: str = "regional_flights_active") -> DataFrame:
    """1 when origin and destination are in the same country, by name or by code."""
    same_name = (F.col("origin_airport_country_name").isNotNull()
                 & F.col("destination_airport_country_name").isNotNull()
                 & (F.col("origin_airport_country_name") == F.col("destination_airport_country_name")))
    same_code = (F.col("origin_airport_country_code").isNotNull()
                 & F.col("destination_airport_country_code").isNotNull()
                 & (F.col("origin_airport_country_code") == F.col("destination_airport_country_code")))
    return df.withColumn(out, F.when(same_name | same_code, F.lit(1)).otherwise(F.lit(0)))


def regional_counts(active: DataFrame) -> DataFrame:
    """Regional active flights per origin country and airline; zero groups stay (A2)."""
    return (regional_flag(active)
            .groupBy(F.col("origin_airport_country_name").alias("country"),
                     F.col("origin_airport_country_code").alias("country_code"),
                     "airline_name", "airline_iata")
            .agg(F.sum("regional_flights_active").cast("bigint").alias("total_regional_flights")))


def manufacturer(model: str = "aircraft_model") -> Column:
    """First word of the aircraft model."""
    return F.split(F.col(model), " ").getItem(0)


def manufacturer_counts(active: DataFrame) -> DataFrame:
    """Active flights per aircraft maker; a NULL model is its own group (A4)."""
    return (active.groupBy(manufacturer().alias("aircraft_manufacturer"))
            .agg(F.count(F.lit(1)).alias("total_active_flights")))


def models_by_country(current: DataFrame) -> DataFrame:
    """Aircraft models in use per origin country, ordered by country, count (falling) and model (A5, O2).

    ``count(model)`` so a NULL-model group counts 0. The order is a distributed
    sort of the aggregated rows, so no country is ranked inside one task.
    """
    agg = (current.groupBy(F.col("origin_airport_country_name").alias("country"), "aircraft_model")
           .agg(F.count("aircraft_model").alias("total_aircraft_model")))
    return agg.orderBy(F.col("country").asc_nulls_first(), F.col("total_aircraft_model").desc(),
                       F.col("aircraft_model").asc_nulls_last())


def route_distance(active: DataFrame) -> DataFrame:
    """Origin-to-destination great-circle km per flight (P10, F1): text coordinates
    go through ``try_cast`` so '' or junk gives NULL instead of a failed task."""
    c = {k: F.col(f"{k}").try_cast("double") for k in (
        "origin_airport_latitude", "origin_airport_longitude",
        "destination_airport_latitude", "destination_airport_longitude")}
    return active.withColumn("distance_km", haversine_km(
        c["origin_airport_latitude"], c["origin_airport_longitude"],
        c["destination_airport_latitude"], c["destination_airport_longitude"]))


def avg_distance(routes: DataFrame, by: Sequence) -> DataFrame:
    """Mean route km per group; NULL distances ignored."""
    return routes.groupBy(*by).agg(F.round(F.avg("distance_km"), ROUND_DIGITS).alias("average_flight_length_km"))


def longest_by_distance(routes: DataFrame) -> DataFrame:
    """Route km of every active flight (O4); ``top_longest_by_distance`` reads the longest."""
    return routes.select("id", "airline_name", "origin_airport_iata", "destination_airport_iata",
                         F.round("distance_km", ROUND_DIGITS).alias("distance_km"))


def top_longest_by_distance(mart: DataFrame, k: int) -> DataFrame:
    """The ``k`` longest routes; NULL distances last, ties by id."""
    return top_k(mart, [F.col("distance_km").desc_nulls_last(), F.col("id").asc()], k)


def hms(seconds: Column) -> Column:
    """Seconds as 'H:MM:SS' with unbounded hours (a duration, not a clock time); NULL for no number."""
    s = seconds.try_cast("bigint")
    return F.when(s.isNotNull(), F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60))


def longest_by_time(active: DataFrame) -> DataFrame:
    """Flight time of every active flight (O3), in seconds and rendered; durations over 24 h do not wrap."""
    return active.select("id", "airline_name",
                         F.col("historical_flighttime").try_cast("bigint").alias("flighttime_seconds"),
                         hms(F.col("historical_flighttime")).alias("flighttime_hms"))


def top_longest_by_time(mart: DataFrame, k: int) -> DataFrame:
    """The ``k`` longest flights by seconds; unknown times last, ties by id."""
    return top_k(mart, [F.col("flighttime_seconds").desc_nulls_last(), F.col("id").asc()], k)


def airport_in_out(current: DataFrame) -> DataFrame:
    """Outbound and inbound flights per airport and their gap.

    The reference aggregates each side and full-outer-joins them. Here every
    flight emits one (airport, out=1) and one (airport, in=1) row and a single
    aggregate counts both: one scan, one shuffle, partial aggregation, and a
    one-sided airport still gets 0 for the missing side. Airports are keyed by
    IATA code alone; the name is the largest seen, so a NULL or variant name
    does not split an airport in two. Counting per (code, name) first keeps
    the big aggregate a hash aggregate (a string ``max`` buffer would force a
    sort of every row); names are folded per code over that small result.
    """
    legs = F.array(
        F.struct(F.col("origin_airport_iata").alias("airport_iata"),
                 F.col("origin_airport_name").alias("airport_name"),
                 F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("destination_airport_iata").alias("airport_iata"),
                 F.col("destination_airport_name").alias("airport_name"),
                 F.lit(0).alias("o"), F.lit(1).alias("i")),
    )
    per_name = (current.select(F.inline(legs)).groupBy("airport_iata", "airport_name")
                .agg(F.sum("o").cast("bigint").alias("o"), F.sum("i").cast("bigint").alias("i")))
    per_airport = per_name.groupBy("airport_iata").agg(
        F.max("airport_name").alias("airport_name"),
        F.sum("o").alias("out_flight_count"), F.sum("i").alias("in_flight_count"))
    return per_airport.withColumn("difference", F.abs(F.col("out_flight_count") - F.col("in_flight_count")))


def _per_airport(current: DataFrame, side: str, out: str) -> DataFrame:
    per_name = (current.groupBy(F.col(f"{side}_airport_iata").alias("airport_iata"),
                                F.col(f"{side}_airport_name").alias("airport_name"))
                .agg(F.count(F.lit(1)).alias("n")))
    return per_name.groupBy("airport_iata").agg(F.max("airport_name").alias("airport_name"),
                                                F.sum("n").alias(out))


def airport_outbound(current: DataFrame) -> DataFrame:
    """Outbound flights per airport."""
    return _per_airport(current, "origin", "out_flight_count")


def airport_inbound(current: DataFrame) -> DataFrame:
    """Inbound flights per airport."""
    return _per_airport(current, "destination", "in_flight_count")


def with_continent(df: DataFrame, continents: DataFrame, country_col: str = "origin_airport_country_name",
                   zone_prefixes: DataFrame | None = None, zone_col: str = "origin_airport_timezone_name",
                   zones: DataFrame | None = None) -> DataFrame:
    """Attach the continent of ``country_col`` from a country -> continent dimension
    (broadcast only after its size is checked).

    With ``zone_prefixes`` a row whose country has no continent there takes that of its time zone's longest
    known prefix. ``zones`` names the time zones there are (the airports'); without it they come from ``df``, which
    is then read twice."""
    dim = continents.withColumnRenamed("country", "__country")
    out = join_dimension(df, dim, F.col(country_col) == F.col("__country"), "left").drop("__country")
    if zone_prefixes is None:
        return out
    zones = df.select(zone_col) if zones is None else zones
    by_zone = zone_continents(zones, zone_prefixes).select(F.col("zone").alias("__zone"), F.col("continent").alias("__by_zone"))
    return (out.join(bounded_broadcast(by_zone, bound_by=zones), F.col(zone_col) == F.col("__zone"), "left")
            .withColumn("continent", F.coalesce("continent", "__by_zone")).drop("__zone", "__by_zone"))


def top_regional_airline_by_continent(active: DataFrame, continents: DataFrame, ties: bool = False,
                                      zone_prefixes: DataFrame | None = None, zones: DataFrame | None = None) -> DataFrame:
    """Airline with the most regional active flights per origin continent."""
    per = (with_continent(regional_flag(active), continents, zone_prefixes=zone_prefixes, zones=zones)
           .groupBy("continent", "airline_name", "airline_iata")
           .agg(F.sum("regional_flights_active").cast("bigint").alias("total_regional_flights")))
    return top_k_per_group(per, "continent",
                           [F.col("total_regional_flights").desc(), F.col("airline_name").asc_nulls_last(),
                            F.col("airline_iata").asc_nulls_last()], k=1, ties=ties)


def avg_distance_by_continent(routes: DataFrame, continents: DataFrame, zone_prefixes: DataFrame | None = None,
                              zones: DataFrame | None = None) -> DataFrame:
    """Mean route km per origin continent."""
    return avg_distance(with_continent(routes, continents, zone_prefixes=zone_prefixes, zones=zones), ["continent"])


def top_models_by_airline_country(current: DataFrame, airline_dim: DataFrame, k: int = 3) -> DataFrame:
    """Top ``k`` aircraft models per airline home country (D3)."""
    per = (join_dimension(current, airline_dim, "airline_name", "left")
           .groupBy("airline_country_name", "aircraft_model")
           .agg(F.count("aircraft_model").alias("total_aircraft_model")))
    return top_k_per_group(per, "airline_country_name",
                           [F.col("total_aircraft_model").desc(), F.col("aircraft_model").asc_nulls_last()],
                           k=k, rank_col="model_rank")


def flown_distance(active: DataFrame) -> DataFrame:
    """Great-circle km from the origin airport to the current position."""
    return active.select("id", F.round(haversine_km(
        F.col("origin_airport_latitude").try_cast("double"), F.col("origin_airport_longitude").try_cast("double"),
        F.col("latitude").try_cast("double"), F.col("longitude").try_cast("double")), ROUND_DIGITS)
        .alias("flown_km"))


def flown_time(active: DataFrame, departure: str = "real_time_departure", fix: str = "extract_ts") -> DataFrame:
    """Seconds from the real departure to the last fix (D6); NULL while the departure is unknown."""
    elapsed = epoch_seconds(fix) - epoch_seconds(departure)
    return active.select("id", elapsed.cast("bigint").alias("flown_seconds"))


def trail_distance(points: DataFrame, key: str = "id", ts: str = "ts", lat: str = "lat", lng: str = "lng",
                   tie_break: Sequence[str] = ()) -> DataFrame:
    """Path length per key over its fixes ordered by time.

    Each fix is paired with the previous fix of the same key by
    ``with_neighbor``, so no key's whole track lands in one task and nothing
    is collected into an array; the legs are summed with a partial aggregate.
    For a trail already held as a bounded array in one row,
    ``functions.geo.path_length_km`` does the same with no shuffle.
    """
    legs = with_neighbor(points, [key], [ts, *tie_break], [lat, lng], "prev", prefix="__p_")
    leg_km = haversine_km(f"__p_{lat}", f"__p_{lng}", lat, lng)
    return (legs.groupBy(key)
            .agg(F.count(F.lit(1)).alias("n_points"),
                 F.round(F.coalesce(F.sum(leg_km), F.lit(0.0)), ROUND_DIGITS).alias("trail_km")))
