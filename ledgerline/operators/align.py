"""Alignment of records to a target table's columns.

The target's ordered column list drives the projection: each target column is
looked up among the record's fields ignoring case and spaces; missing ones
become typed nulls; fields the target lacks are dropped. Listed columns are
converted from their integer encodings (timestamp list first, then date, then
time), and every value is cast to the target column's type. Name resolution
happens once on the driver against the schema; the data sees one projection.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.constants import IH_COLUMNS
from ledgerline.functions.names import name_in, norm, resolve
from ledgerline.functions.temporal import days_to_date, millis_to_local_datetime, nanos_to_time_text
from ledgerline.sources.decode import entry_lookup, field_value, fields_by_name, lowered_entries

# More target columns than this are looked up in one pass over a record's fields.
WIDE = 16

log = logging.getLogger(__name__)


def _as_fields(target) -> list[T.StructField]:
    if isinstance(target, T.StructType):
        return list(target.fields)
    if isinstance(target, DataFrame):
        return list(target.schema.fields)
    fields = []
    for item in target:
        if isinstance(item, T.StructField):
            fields.append(item)
        elif isinstance(item, str):
            fields.append(T.StructField(item, T.NullType(), True))
        else:
            name, dtype = item
            dtype = T._parse_datatype_string(dtype) if isinstance(dtype, str) else dtype
            fields.append(T.StructField(name, dtype, True))
    return fields


def _positional(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Rename columns whose names collide ignoring case, by position.

    Spark resolves names case-insensitively, so ``Id`` next to ``ID`` cannot be
    selected by name. Returns the frame and original-name -> usable-name; the
    first of the colliding names keeps mapping to its own column.
    """
    names = df.columns
    lowered = [n.lower() for n in names]
    if len(set(lowered)) == len(lowered):
        return df, {n: n for n in names}
    safe = [n if lowered.count(n.lower()) == 1 else f"{n}__pos{i}" for i, n in enumerate(names)]
    mapping: dict[str, str] = {}
    for orig, new in zip(names, safe):
        mapping.setdefault(orig, new)
    return df.toDF(*safe), mapping


def convert_value(
    value: Column,
    name: str,
    target_type: T.DataType,
    timestamps: Iterable[str] = (),
    dates: Iterable[str] = (),
    times: Iterable[str] = (),
    zone: str = "UTC",
    date_mode: str = "true",
) -> Column:
    """Apply the first matching conversion list, then cast to ``target_type``."""
    if name_in(name, timestamps):
        value = millis_to_local_datetime(value.cast("bigint"), zone)
    elif name_in(name, dates):
        value = days_to_date(value.cast("bigint"), zone, date_mode)
    elif name_in(name, times):
        if isinstance(target_type, (T.StringType, T.NullType)):
            value = nanos_to_time_text(value.cast("bigint"))
        else:
            value = value.cast("bigint")
    if isinstance(target_type, T.NullType):
        return value
    return value.cast(target_type)


def align_to_target(
    df: DataFrame,
    target,
    timestamps: Sequence[str] = (),
    dates: Sequence[str] = (),
    times: Sequence[str] = (),
    zone: str = "UTC",
    date_mode: str = "true",
    map_col: str | None = None,
    on_duplicate: str | None = None,
) -> DataFrame:
    """Project ``df`` onto the ordered columns of ``target``.

    ``target`` is a schema, a DataFrame, or a list of names / ``(name, type)``.
    Untyped targets keep the source type. With ``map_col`` the record's fields
    are looked up in that text map (schemaless records); of the top-level
    columns only the provenance columns (``ih_*``) win over the map.
    """
    fields = _as_fields(target)
    if not fields:
        raise ValueError("target has no columns")
    df, physical = _positional(df)
    own = {norm(c) for c in IH_COLUMNS}
    available = [c for c in physical if c != map_col and (map_col is None or norm(c) in own)]
    entries = None
    wide = map_col is not None and len(fields) > WIDE
    if wide:
        entries = "__fields"
        df = df.withColumn(entries, fields_by_name(physical.get(map_col, map_col), [f.name for f in fields]))
    elif map_col is not None:
        # lower-case the map's keys once per row, not once per target column
        entries = "__entries"
        df = df.withColumn(entries, lowered_entries(physical.get(map_col, map_col)))
    dup = on_duplicate or ("last" if map_col else "first")
    out = []
    for field in fields:
        source = resolve(field.name, available, dup)
        if source is not None:
            value = F.col(f"`{physical[source]}`")
        elif wide:
            value = field_value(entries, field.name)
        elif entries is not None:
            value = entry_lookup(entries, field.name)
        else:
            log.warning("column %s not found in records; filled with null", field.name)
            value = F.lit(None)
        if isinstance(field.dataType, T.NullType) and source is None and map_col is None:
            value = value.cast("string")
        out.append(convert_value(value, field.name, field.dataType, timestamps, dates, times, zone, date_mode).alias(field.name))
    return df.select(*out)
