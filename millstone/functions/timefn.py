"""Time helpers on ``TIMESTAMP_NTZ`` columns.

All of them are independent of ``spark.sql.session.timeZone``:
``date_trunc`` would return a session-zone ``TIMESTAMP`` for NTZ input, so
hour/day/week buckets are rebuilt with ``make_timestamp_ntz`` / date math.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millstone.sources.refdata import LOCAL_TZ


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def to_local(ts, tz: str = LOCAL_TZ) -> Column:
    """UTC wall clock -> plant-local wall clock (both NTZ)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ts))


def hour_start(ts) -> Column:
    t = _c(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))


def day_start(ts) -> Column:
    """Midnight of the same calendar day, as NTZ."""
    return F.to_date(_c(ts)).cast("timestamp_ntz")


def day_of(ts) -> Column:
    return F.to_date(_c(ts))


def week_start(ts) -> Column:
    """Monday 00:00 of the ISO week, as NTZ."""
    return F.trunc(F.to_date(_c(ts)), "week").cast("timestamp_ntz")


def iso_dow(ts) -> Column:
    """1 = Monday … 7 = Sunday."""
    return (F.weekday(_c(ts)) + 1).cast("int")


def minute_of_day(ts) -> Column:
    t = _c(ts)
    return (F.hour(t) * 60 + F.minute(t)).cast("int")


def micros_text(ts) -> Column:
    """``YYYY-MM-DD HH:MI:SS.ffffff`` — the timestamp part of event keys.
    NTZ -> string is zone-free but trims the fraction, so the fraction is
    re-padded to 6 digits (``date_format`` would pass the value through the
    session zone and shift wall clocks inside a DST gap)."""
    s = _c(ts).cast("string")
    return F.concat(F.substring(s, 1, 19), F.lit("."), F.rpad(F.substring(s, 21, 6), 6, "0"))


def event_id(asset="asset", ts="event_ts", version="schema_version") -> Column:
    """Surrogate key ``ASSET|ts(µs)|SCHEMA_VERSION``; NULL if any part is NULL
    (``||`` semantics, never ``concat_ws``)."""
    return F.concat(_c(asset), F.lit("|"), micros_text(ts), F.lit("|"), _c(version))


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of an NTZ wall clock, computed from
    calendar fields only (no session-zone conversion)."""
    t = _c(ts)
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long")
    secs = F.extract(F.lit("SECOND"), t)               # decimal(8,6) incl. fraction
    return (days * F.lit(86400000000) + F.hour(t).cast("long") * F.lit(3600000000)
            + F.minute(t).cast("long") * F.lit(60000000) + (secs * 1000000).cast("long"))
