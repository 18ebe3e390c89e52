"""Flights in progress.

The reference reads the wall clock on the driver at plan time and compares
formatted strings. Here the caller passes ``as_of`` and the compare is a typed
timestamp compare, so results are reproducible and time-zone independent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.timefmt import ts_literal

# Fixed value: status text marking a finished flight.
LANDED_MARKER = "Landed"


def arrival_time(estimated: str = "estimated_arrival", scheduled: str = "scheduled_time_arrival"):
    """Estimated arrival when known, else the scheduled one."""
    return F.coalesce(F.col(estimated), F.col(scheduled))


def with_current_flag(df: DataFrame, as_of) -> DataFrame:
    """Add ``is_current`` / ``end_time`` against ``as_of`` without filtering (serving table, D8).

    A flight is current unless its arrival is before ``as_of``; an unknown
    arrival counts as current. ``end_time`` is ``as_of`` for finished flights.
    """
    now = ts_literal(as_of)
    finished = arrival_time() < now
    return df.withColumns({
        "is_current": F.when(finished, F.lit(False)).otherwise(F.lit(True)),
        "end_time": F.when(finished, now),
    })


def current_flights(df: DataFrame, as_of) -> DataFrame:
    """Rows whose arrival is unknown or not before ``as_of`` (P7), with
    ``is_current`` (true) and ``end_time`` (NULL: the flight has not ended).

    Written as a plain disjunction on the two stored columns so the predicate
    is evaluated right after the scan/join, before any shuffle.
    """
    now = ts_literal(as_of)
    arr = arrival_time()
    return df.where(arr.isNull() | (arr >= now)).withColumns(
        {"is_current": F.lit(True), "end_time": F.lit(None).cast("timestamp_ntz")})


def active_flights(df: DataFrame, on_ground: str = "on_ground", status: str = "status_text") -> DataFrame:
    """Airborne and not landed (P8). A NULL status drops the row, as in SQL
    three-valued logic; ``on_ground`` text that is not a number also drops it."""
    return df.where((F.col(on_ground).try_cast("int") == 0) & ~F.col(status).contains(LANDED_MARKER))


def current_versions(df: DataFrame, flag: str = "is_current") -> DataFrame:
    """Stored-version predicate ``is_current = true`` (P9); on a table
    partitioned by the flag this prunes the closed part at the scan."""
    return df.where(F.col(flag))
