"""Table maintenance as DataFrame functions.

- ``expire_landing``: drop landing rows processed more than a retention
  window before ``now``; rows without a processing time stay.
- ``compact_latest``: in an append-only changelog keep, per key, the rows at
  the greatest offset (ties all kept); rows with a null key or offset stay.
- ``reload_on_gap``: a load that comes after a quiet period of at least
  ``gap`` whole minutes first empties the table, so the table holds the rows
  since the last such gap.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.constants import IH_DATETIME, IH_OFFSET, LANDING_RETENTION, RELOAD_GAP_SECONDS
from ledgerline.functions.temporal import ntz_literal, whole_minutes_between

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def parse_interval(text: str | _dt.timedelta) -> _dt.timedelta:
    """``'4 hours'`` / ``'PT4H'`` / timedelta -> timedelta."""
    if isinstance(text, _dt.timedelta):
        return text
    t = text.strip()
    if t.upper().startswith("PT") or t.upper().startswith("P"):
        import re

        m = re.fullmatch(r"P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?)?", t.upper())
        if not m:
            raise ValueError(f"bad ISO-8601 duration {text!r}")
        d, h, mi, s = (float(g) if g else 0.0 for g in m.groups())
        return _dt.timedelta(days=d, hours=h, minutes=mi, seconds=s)
    amount, unit = t.split()
    unit = unit.lower().rstrip("s")
    return _dt.timedelta(seconds=float(amount) * _UNITS[unit])


def expire_landing(
    df: DataFrame,
    now: _dt.datetime | str,
    keep: str | _dt.timedelta = LANDING_RETENTION,
    ts_col: str = IH_DATETIME,
) -> DataFrame:
    """Rows not older than ``now - keep`` (strict), plus rows with null time.

    The cutoff is a literal, so the predicate reaches the Parquet scan and
    prunes partitions by processing date.
    """
    if isinstance(now, str):
        now = _dt.datetime.fromisoformat(now)
    cutoff = now - parse_interval(keep)
    ts = F.col(ts_col)
    return df.filter((ts >= ntz_literal(cutoff)) | ts.isNull())


def compact_latest(df: DataFrame, keys: Sequence[str], offset_col: str = IH_OFFSET) -> DataFrame:
    """Keep rows whose offset is not below their key's greatest offset.

    The per-key maximum is a partial aggregate (one row per key per map task
    crosses the shuffle) joined back on the key. That join is skew-safe: AQE
    splits an oversized key partition of the changelog side, and the small
    side holds one row per key. A window over the key would instead buffer a
    hot key's whole history in one task.
    """
    keys = list(keys)
    offset = F.col(offset_col)
    if isinstance(df.schema[offset_col].dataType, T.StringType):
        # changelog offsets are stored as text: compare them as numbers
        offset = F.expr(f"try_cast(`{offset_col}` AS BIGINT)")
    with_num = df.withColumn("__offset_num", offset)
    maxes = with_num.groupBy(*keys).agg(F.max("__offset_num").alias("__max_offset"))
    joined = with_num.join(maxes, on=keys, how="left")
    below = F.col("__offset_num") < F.col("__max_offset")
    return joined.filter(~F.coalesce(below, F.lit(False))).select(*df.columns)


def reload_on_gap(
    df: DataFrame,
    ts_col: str,
    gap_seconds: int = RELOAD_GAP_SECONDS,
) -> DataFrame:
    """Rows since the last reload: the last arrival after a gap of more than
    ``gap_seconds // 60`` whole minutes since the previous arrival.

    Scales without a global sort: arrivals are first reduced to per-minute
    first/last times (partial aggregate; a gap of 31+ minutes cannot hide
    inside one minute), the previous busy minute is found with a window
    partitioned by day, and the first minute of a day looks back at the last
    busy day before it, from a table of one row per busy day (a few tens of
    thousands for a century, whatever the input). The reload point (one value)
    is read back and applied as a literal filter, which reaches the scan.
    """
    limit_minutes = gap_seconds // 60
    ts = F.col(ts_col).cast("timestamp_ntz")
    minute = F.date_trunc("minute", ts)
    per_minute = (
        df.where(F.col(ts_col).isNotNull())
        .groupBy(minute.alias("__minute"))
        .agg(F.min(ts).alias("__first"), F.max(ts).alias("__last"))
        .withColumn("__day", F.to_date("__minute"))
    )
    in_day = Window.partitionBy("__day").orderBy("__minute")
    with_prev = per_minute.withColumn("__prev_last", F.lag("__last").over(in_day))
    per_day = per_minute.groupBy("__day").agg(F.max("__last").alias("__day_last"))
    days = Window.orderBy("__day")
    last_busy_day = per_day.select("__day", F.lag("__day_last").over(days).alias("__prev_day_last"))
    gaps = with_prev.join(last_busy_day, on="__day", how="left").withColumn(
        "__before", F.coalesce("__prev_last", "__prev_day_last")
    )
    minutes = whole_minutes_between("__before", "__first")
    start = gaps.where(minutes > F.lit(limit_minutes)).agg(F.max("__first")).first()[0]
    if start is None:
        return df
    # one value read back; as a literal the filter reaches the Parquet scan
    return df.where((ts >= ntz_literal(start)) | F.col(ts_col).isNull())
