"""Dimension joins with a size check in front of every broadcast.

A side is broadcast only when the bytes of the table it comes from, as the
planner knows them from the files, are within Spark's own broadcast
threshold. The check reads no data, runs no job and remembers nothing, so a
table that has grown is seen as it is. Beyond the threshold the join is left to
Catalyst + AQE (shuffle join, converted at runtime if the shuffled side
turns out small).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes a broadcast table may have on disk. Override per session.
DEFAULT_BROADCAST_BYTES = 10 << 20
BROADCAST_BYTES_CONF = "contrail.broadcast.maxBytes"


def planned_bytes(df: DataFrame) -> int:
    """The planner's size of a table, from its file lengths."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_bounded(df: DataFrame, max_bytes: int | None = None) -> bool:
    if max_bytes is None:
        max_bytes = int(df.sparkSession.conf.get(BROADCAST_BYTES_CONF, str(DEFAULT_BROADCAST_BYTES)))
    return planned_bytes(df) <= max_bytes


def bounded_broadcast(df: DataFrame, max_bytes: int | None = None, bound_by: DataFrame | None = None) -> DataFrame:
    """``broadcast(df)`` if its table is small enough, else ``df`` unchanged.

    ``bound_by`` is the table that ``df`` is derived from without growing (a
    projection, filter or N:1 lookup join of it).
    """
    return F.broadcast(df) if is_bounded(df if bound_by is None else bound_by, max_bytes) else df


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "left",
                   max_bytes: int | None = None) -> DataFrame:
    return fact.join(bounded_broadcast(dim, max_bytes), on, how)


def continent_dim(nation: DataFrame, region: DataFrame) -> DataFrame:
    """country name -> continent, from the nation and region tables."""
    return (nation.join(bounded_broadcast(region), nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_name").alias("country"), F.col("r_name").alias("continent")))


def airline_country_dim(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """airline name -> the airline's home country, one row per airline.

    The supplier's nation. An airline name that stands for suppliers of several
    nations takes the smallest country name, so a join on it never multiplies rows.
    """
    named = supplier.join(bounded_broadcast(nation), supplier.s_nationkey == nation.n_nationkey, "left")
    return named.groupBy(F.col("s_name").alias("airline_name")).agg(F.min("n_name").alias("airline_country_name"))


# What the first part of a time zone's name says of its continent, and longer names that say otherwise.
ZONE_CONTINENTS = {
    "Africa": "AFRICA", "America": "AMERICA", "Antarctica": "ANTARCTICA", "Arctic": "EUROPE", "Asia": "ASIA",
    "Australia": "OCEANIA", "Europe": "EUROPE", "Pacific": "OCEANIA", "Pacific/Galapagos": "AMERICA",
    "Pacific/Easter": "AMERICA", "Atlantic/Azores": "EUROPE", "Atlantic/Bermuda": "AMERICA", "Atlantic/Canary": "EUROPE",
    "Atlantic/Cape_Verde": "AFRICA", "Atlantic/Faroe": "EUROPE", "Atlantic/Madeira": "EUROPE", "Atlantic/Reykjavik": "EUROPE",
    "Atlantic/St_Helena": "AFRICA", "Atlantic/Stanley": "AMERICA", "Indian/Antananarivo": "AFRICA", "Indian/Comoro": "AFRICA",
    "Indian/Mauritius": "AFRICA", "Indian/Mayotte": "AFRICA", "Indian/Reunion": "AFRICA", "Indian/Maldives": "ASIA",
}


def zone_prefix_dim(spark: SparkSession, prefixes: Mapping[str, str] = ZONE_CONTINENTS) -> DataFrame:
    """(prefix, continent) of time-zone names; a prefix is whole parts between slashes."""
    return spark.createDataFrame(list(prefixes.items()), "prefix STRING, continent STRING")


def zone_continents(zones: DataFrame, prefixes: DataFrame) -> DataFrame:
    """time zone -> continent by its longest known prefix; a zone without one is left out.

    ``zones`` has the names in its first column, repeated or null ones too. Each distinct zone is exploded into
    its prefixes ('a/b/c': 'a', 'a/b', 'a/b/c') and those meet ``prefixes`` in an equi-join, so rows grow by the parts
    of a name and not by the prefixes known. A prefix given twice counts with its largest continent.
    """
    zone = zones.select(F.col(f"`{zones.columns[0]}`").alias("zone")).where("zone IS NOT NULL").distinct()
    parts = F.split("zone", "/")
    cut = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    steps = zone.select("zone", F.posexplode(cut).alias("depth", "prefix"))
    known = prefixes.select("prefix", "continent").where("continent IS NOT NULL")
    return (steps.join(bounded_broadcast(known), "prefix").groupBy("zone")
            .agg(F.max(F.struct("depth", "continent"))["continent"].alias("continent")))
