"""Image routing and record projection.

A delete carries its row in ``before``, every other op in ``after``. Routing
flattens the chosen image into top-level columns and renames the record's
position to provenance columns (``ih_topic, ih_partition, ih_offset, ih_op``),
which win over same-named image fields. The key struct, if any, is kept as
``ih_key`` so conflation can group on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.constants import (
    AFTER,
    BEFORE,
    IH_COLUMNS,
    IH_OFFSET,
    IH_OP,
    IH_PARTITION,
    IH_TOPIC,
    OFFSET,
    OP,
    OP_DELETE,
    PARTITION,
    PLAIN_OP,
    TIMESTAMP,
    TOPIC,
)
from ledgerline.functions.names import norm

IH_KEY = "ih_key"
# The record's own time, if the source has one: it orders a key's changes across partitions.
RECORD_TIME = "ih_record_time"
_RECORD_TO_IH = {TOPIC: IH_TOPIC, PARTITION: IH_PARTITION, OFFSET: IH_OFFSET, OP: IH_OP, "key": IH_KEY, TIMESTAMP: RECORD_TIME}


def _record_columns(df: DataFrame, keep: Sequence[str]) -> dict:
    """Output name -> column for the record's position fields and ``keep``."""
    out = {alias: F.col(f"`{name}`").alias(alias) for name, alias in _RECORD_TO_IH.items() if name in df.columns}
    out.update({k: F.col(f"`{k}`") for k in keep})
    return out


def _image_fields(image_type: T.StructType, taken: Sequence[str]) -> list[str]:
    reserved = {norm(t) for t in taken}
    return [f.name for f in image_type.fields if norm(f.name) not in reserved]


def route_image(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``op = d`` takes ``before``, else ``after``; flatten it next to provenance.

    ``keep`` names extra record columns to carry (e.g. an arrival sequence).
    """
    image_type = df.schema[AFTER].dataType
    image = F.when(F.col(OP) == F.lit(OP_DELETE), F.col(BEFORE)).otherwise(F.col(AFTER))
    record = _record_columns(df, keep)
    fields = _image_fields(image_type, list(record) + list(IH_COLUMNS))
    routed = df.select(*record.values(), image.alias("__image"))
    kept = [F.col(f"`{c}`") for c in routed.columns if c != "__image"]
    return routed.select(*kept, *[F.col("__image")[f].alias(f) for f in fields])


def plain_records(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Non-CDC records: every value field is the row, with op ``c``.

    Input has ``topic, partition, offset`` and the row's fields as columns.
    """
    record = [c for c in (TOPIC, PARTITION, OFFSET) if c in df.columns]
    payload = [c for c in df.columns if c not in record and c not in keep and norm(c) not in {norm(i) for i in IH_COLUMNS}]
    return df.select(
        *[F.col(c).alias(_RECORD_TO_IH[c]) for c in record],
        F.lit(PLAIN_OP).alias(IH_OP),
        *[F.col(f"`{k}`") for k in keep],
        *[F.col(f"`{p}`") for p in payload],
    )
