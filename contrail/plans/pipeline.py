"""The indicator jobs as one Spark application.

The reference runs seven scripts that each rescan the silver table and
recompute the current/active sets. Here the current and active sets are
built once; when several indicators read the same set it is persisted for
the duration of the run (and released after), and every indicator is
published as a mart under the run's ``as_of``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.timefmt import STAMP_FORMATS
from contrail.operators import indicators as I
from contrail.operators.current import active_flights, current_flights
from contrail.sources.sinks import latest_run, read_table, write_run

# name -> (input set, builder(input, dims))
INDICATORS: dict[str, tuple[str, Callable[[DataFrame, dict], DataFrame]]] = {
    "current_flight_by_airline": ("active", lambda a, d: I.airline_counts(a)),
    "regional_flight": ("active", lambda a, d: I.regional_counts(a)),
    "longest_flight_by_time": ("active", lambda a, d: I.longest_by_time(a)),
    "longest_flight_by_distance": ("active", lambda a, d: I.longest_by_distance(I.route_distance(a))),
    "avg_distance_by_country": ("active", lambda a, d: I.avg_distance(
        I.route_distance(a), [F.col("origin_airport_country_name").alias("country"),
                              F.col("origin_airport_country_code").alias("country_code")])),
    "aircraft_company_flight": ("active", lambda a, d: I.manufacturer_counts(a)),
    "aircraft_model_by_country": ("current", lambda c, d: I.models_by_country(c)),
    "in_out_flight": ("current", lambda c, d: I.airport_in_out(c)),
    "top_regional_airline_by_continent": ("active", lambda a, d: I.top_regional_airline_by_continent(
        a, d["continents"])),
    "avg_distance_by_continent": ("active", lambda a, d: I.avg_distance_by_continent(
        I.route_distance(a), d["continents"])),
    "top3_models_by_airline_country": ("current", lambda c, d: I.top_models_by_airline_country(
        c, d["airline_countries"], 3)),
}


# The columns indicators read; nothing else is persisted.
USED_COLUMNS = (
    "id", "airline_name", "airline_iata", "aircraft_model", "on_ground", "status_text", "historical_flighttime",
    *(f"{side}_airport_{a}" for side in ("origin", "destination") for a in (
        "iata", "name", "country_name", "country_code", "latitude", "longitude")),
)


def build_indicators(silver: DataFrame, as_of, dims: dict | None = None, names: Iterable[str] | None = None
                     ) -> dict[str, DataFrame]:
    """Lazy DataFrames, one per requested indicator, over the current versions of ``silver``."""
    dims = dims or {}
    names = list(names or INDICATORS)
    current = current_flights(silver, as_of)
    sets = {"current": current, "active": active_flights(current)}
    return {n: INDICATORS[n][1](sets[INDICATORS[n][0]], dims) for n in names}


def publish_indicators(silver: DataFrame, as_of, out_root: str, dims: dict | None = None,
                       names: Iterable[str] | None = None) -> list[str]:
    """Compute and publish the requested indicators as marts under ``out_root/<name>``.

    The current/active sets are persisted only if more than one indicator
    reads them, and unpersisted when the run ends (also on failure).
    """
    dims = dims or {}
    names = list(names or INDICATORS)
    current = current_flights(silver, as_of).select(*[c for c in USED_COLUMNS if c in silver.columns])
    active = active_flights(current)
    uses = {s: sum(INDICATORS[n][0] == s for n in names) for s in ("current", "active")}
    shared = []
    if uses["active"] + uses["current"] > 1:
        current = current.persist(StorageLevel.MEMORY_AND_DISK)
        shared.append(current)
        active = active_flights(current)
    sets = {"current": current, "active": active}
    try:
        for n in names:
            src, build = INDICATORS[n]
            write_run(build(sets[src], dims), f"{out_root}/{n}", as_of)
    finally:
        for df in shared:
            df.unpersist()
    return names


def read_latest_marts(spark: SparkSession, out_root: str, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The newest run of each mart under ``out_root`` (S12), stamps as text; a mart that was never published raises.

    Each is lazy and reads its newest run's folder only.
    """
    marts = {}
    for n in names or INDICATORS:
        schema = spark.read.parquet(f"{out_root}/{n}").schema
        full = T.StructType([T.StructField(f.name, T.StringType()) if f.name in STAMP_FORMATS else f for f in schema])
        marts[n] = latest_run(read_table(spark, f"{out_root}/{n}", full))
    return marts
