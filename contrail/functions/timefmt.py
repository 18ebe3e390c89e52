"""Time helpers that do not depend on the session time zone.

Driver tables load as ``timestamp_ntz``. All conversions here stay in NTZ
arithmetic (``timestamp_add``) and calendar fields, so results are the same
whatever ``spark.sql.session.timeZone`` the caller runs with.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of the extraction stamp columns.
STAMP_FORMATS = {
    "extract_year": "yyyy",
    "extract_month": "yyyy_MM",
    "extract_day": "yyyy_MM_dd",
}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# 0001-01-01 00:00:00 and 9999-12-31 23:59:59 as epoch seconds.
MIN_EPOCH, MAX_EPOCH = -62_135_596_800, 253_402_300_799


def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ts_literal(value) -> Column:
    """An ``as_of`` argument (datetime, 'yyyy-MM-dd HH:mm:ss' text or Column) as NTZ."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    # A string cast to NTZ is zone-free; a Python datetime literal is not.
    return F.lit(str(value)).cast("timestamp_ntz")


def _epoch_day(ts: Column) -> Column:
    return F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 of an NTZ timestamp (BIGINT, floored).

    Built from calendar fields (day number, hour, minute, second), which are
    zone-free for NTZ; ``timestamp_diff`` on NTZ values applies the session
    zone and is off by an hour around daylight-saving gaps.
    """
    t = _c(ts)
    return _epoch_day(t) * 86400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of an NTZ timestamp (BIGINT), zone-free."""
    t = _c(ts)
    return ((_epoch_day(t) * 86400 + F.hour(t) * 3600 + F.minute(t) * 60) * 1_000_000
            + (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("bigint"))


def epoch_to_ts(text) -> Column:
    """Epoch seconds held as text/number -> ``timestamp_ntz``.

    Dirty input ('' / 'N/A' / junk, or a number outside the years 0001-9999)
    becomes NULL instead of failing the task under ANSI mode.
    """
    secs = _c(text).try_cast("bigint")
    # The bound sits inside the argument too: Spark may evaluate it ahead of the condition.
    known = F.when(secs.between(MIN_EPOCH, MAX_EPOCH), secs)
    return F.timestamp_add("SECOND", known, epoch_ntz())


def duration(seconds) -> Column:
    """Seconds -> day-time interval; unlike a clock format it does not wrap at 24 h."""
    secs = _c(seconds).try_cast("bigint")
    # An interval holds about 1e11 seconds with six decimals; more is junk.
    secs = F.when(F.abs(secs.cast("decimal(20,0)")) <= MAX_EPOCH, secs)
    return F.make_dt_interval(secs=secs.cast("decimal(18,6)"))


def stamp_columns(ts) -> dict[str, Column]:
    """The four extraction stamp columns derived from one timestamp column or ``as_of``."""
    ts = _c(ts) if isinstance(ts, str) and not ts[:1].isdigit() else ts_literal(ts)
    out = {name: F.date_format(ts, fmt) for name, fmt in STAMP_FORMATS.items()}
    out["extract_time"] = epoch_seconds(ts)
    return out
