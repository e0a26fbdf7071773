"""Provenance columns.

Landing rows carry where they came from (topic, partition, offset, op), when
they were processed (UTC wall clock, one value per batch) and which block
(flush) wrote them. Changelog rows carry the first four, with the offset as
text, as the append-only sink stores it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.constants import IH_BLOCKID, IH_DATETIME, IH_OFFSET, IH_OP, IH_PARTITION, IH_TOPIC
from ledgerline.functions.temporal import ntz_literal, utc_now_ntz


def add_provenance(
    df: DataFrame,
    block_id: str | None = None,
    now: _dt.datetime | str | None = None,
    variant: str = "landing",
) -> DataFrame:
    """Add (or replace) provenance columns on routed rows.

    ``variant='landing'`` adds ``ih_datetime`` and ``ih_blockid``;
    ``variant='changelog'`` turns ``ih_offset`` into text and adds nothing.
    ``now`` fixes the processing time (tests, retries); default is the
    query's current UTC time.
    """
    for c in (IH_TOPIC, IH_PARTITION, IH_OFFSET, IH_OP):
        if c not in df.columns:
            raise ValueError(f"missing provenance source column {c}; route the records first")
    if variant == "changelog":
        return df.withColumns(
            {
                IH_TOPIC: F.col(IH_TOPIC).cast("string"),
                IH_PARTITION: F.col(IH_PARTITION).cast("int"),
                IH_OFFSET: F.col(IH_OFFSET).cast("string"),
                IH_OP: F.col(IH_OP).cast("string"),
            }
        )
    if variant != "landing":
        raise ValueError(f"unknown provenance variant {variant!r}")
    if block_id is None:
        raise ValueError("landing provenance needs a block id")
    stamp = utc_now_ntz() if now is None else ntz_literal(now)
    return df.withColumns(
        {
            IH_OFFSET: F.col(IH_OFFSET).cast("bigint"),
            IH_DATETIME: stamp,
            IH_BLOCKID: F.lit(block_id),
        }
    )
