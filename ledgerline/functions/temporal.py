"""Temporal conversions of integer-encoded change-record fields.

- epoch milliseconds -> local date-time (TIMESTAMP_NTZ, wall clock in a zone)
- epoch days -> DATE
- nanoseconds of day -> ``HH:mm[:ss[.fff|.ffffff|.fffffffff]]`` text

All are built-in Column expressions (no UDF), so they stay in whole-stage
codegen and do not depend on the session time zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

NANOS_PER_SECOND = 1_000_000_000
NANOS_PER_DAY = 86_400 * NANOS_PER_SECOND


def epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def millis_to_local_datetime(col, zone: str = "UTC") -> Column:
    """Epoch millis -> wall-clock time in ``zone``, as TIMESTAMP_NTZ."""
    utc_wall = F.timestamp_add("MILLISECOND", _c(col).cast("bigint"), epoch_ntz())
    if zone.upper() in ("UTC", "Z", "GMT", "ETC/UTC"):
        return utc_wall
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall)


def days_to_date(col, zone: str = "UTC", mode: str = "true") -> Column:
    """Epoch days -> DATE.

    ``mode='true'`` is the calendar date of day ``n``. ``mode='zoned'`` reads
    midnight UTC of day ``n`` as a wall clock in ``zone`` and takes its date,
    which is one day earlier west of Greenwich.
    """
    if mode == "true":
        return F.date_from_unix_date(_c(col).cast("int"))
    if mode != "zoned":
        raise ValueError(f"unknown date mode {mode!r}")
    return F.to_date(millis_to_local_datetime(_c(col).cast("bigint") * F.lit(86_400_000), zone))


def nanos_to_time_text(col) -> Column:
    """Nanos of day -> ISO local-time text; null outside ``[0, 1 day)``.

    Minutes are always printed; seconds only when seconds or nanos are non-zero;
    the fraction with 3, 6 or 9 digits, the fewest that hold it exactly.
    """
    n = _c(col).cast("bigint")
    secs = F.floor(n / F.lit(NANOS_PER_SECOND)).cast("bigint")
    nano = F.pmod(n, F.lit(NANOS_PER_SECOND))
    sec_of_min = F.pmod(secs, F.lit(60))

    def pad(value: Column, width: int) -> Column:
        return F.lpad(value.cast("bigint").cast("string"), width, "0")

    frac = (
        F.when(nano == 0, F.lit(""))
        .when(F.pmod(nano, F.lit(1_000_000)) == 0, F.concat(F.lit("."), pad(F.floor(nano / 1_000_000), 3)))
        .when(F.pmod(nano, F.lit(1_000)) == 0, F.concat(F.lit("."), pad(F.floor(nano / 1_000), 6)))
        .otherwise(F.concat(F.lit("."), pad(nano, 9)))
    )
    seconds_part = F.when((sec_of_min == 0) & (nano == 0), F.lit("")).otherwise(
        F.concat(F.lit(":"), pad(sec_of_min, 2), frac)
    )
    text = F.concat(pad(F.floor(secs / 3600), 2), F.lit(":"), pad(F.pmod(F.floor(secs / 60), F.lit(60)), 2), seconds_part)
    return F.when((n >= 0) & (n < F.lit(NANOS_PER_DAY)), text)


def micros_of_ntz(col) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ, read as a UTC wall clock."""
    return F.timestamp_diff("MICROSECOND", epoch_ntz(), _c(col).cast("timestamp_ntz"))


def local_datetime_text(col) -> Column:
    """TIMESTAMP_NTZ -> ISO local date-time text (``T`` separator, same seconds rule)."""
    ts = _c(col).cast("timestamp_ntz")
    nanos_of_day = F.pmod(micros_of_ntz(ts), F.lit(86_400_000_000)) * F.lit(1000)
    return F.concat(F.date_format(ts, "yyyy-MM-dd"), F.lit("T"), nanos_to_time_text(nanos_of_day))


def whole_minutes_between(start, end) -> Column:
    """Whole minutes from ``start`` to ``end``, truncated toward zero."""
    return F.timestamp_diff("MINUTE", _c(start).cast("timestamp_ntz"), _c(end).cast("timestamp_ntz"))


def utc_now_ntz() -> Column:
    """Current UTC wall-clock time as TIMESTAMP_NTZ, fixed per query."""
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal from a ``datetime`` or ISO text."""
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return F.expr(f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'")
