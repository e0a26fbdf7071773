"""Shard placement by a permutation-filled lookup table (operator 3).

Every shard has its own order of preference over a table of a prime number of
slots (offset and skip from the digest of its name); shards take turns
claiming their next free slot until the table is full, so slots per shard
differ by at most one and losing a shard moves few keys of the others. A key's
slot is its hash modulo the table size: one broadcast equi-join places a row.

The table has ``SLOTS`` rows whatever the input, which bounds the broadcast.
Placement needs no shuffle and no state, so a hot source or a run of copies is
spread like anything else: rows are placed by ``doc_id``, not by source. Null
keys hash like any value; repeated rows share a shard; an empty table gives no
rows. Columns named ``slot`` or ``shard`` in the input are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLOTS, SHARDS = 65_537, 256


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], slots: int = SLOTS) -> np.ndarray:
    """The index of the shard that owns each slot."""
    if not _is_prime(slots) or not 0 < len(shards) <= slots:
        raise ValueError("the table size must be a prime and hold every shard")
    if len(set(shards)) != len(shards):
        raise ValueError("shard names repeat")
    digests = [hashlib.sha256(name.encode()).digest() for name in shards]
    at = [int.from_bytes(d[:8], "big") % slots for d in digests]
    skip = [int.from_bytes(d[8:16], "big") % (slots - 1) + 1 for d in digests]
    owner = [-1] * slots
    free = slots
    while free:
        for shard in range(len(shards)):
            if not free:
                break
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + skip[shard]) % slots
            owner[at[shard]] = shard
            free -= 1
    return np.array(owner, dtype=np.int32)


def place(spark: SparkSession, df: DataFrame, keys: list[str], shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` (a name of ``shards``)."""
    table = lookup_table(shards, slots)
    rows = spark.createDataFrame(pd.DataFrame({"slot": np.arange(slots), "shard": np.array(shards, dtype=object)[table]}), "slot long, shard string")
    slot = F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys]), F.lit(slots))
    return df.drop("slot", "shard").withColumn("slot", slot).join(F.broadcast(rows), "slot")


def write_shards(placed: DataFrame, path: str, parts: int = 8) -> None:
    """One folder per shard, each in up to ``parts`` files: rows are spread by
    shard and a hash of all their columns, so that no task holds a whole shard
    and rows that share one key (null, a repeated id) are split by their text.
    Equal rows stay together."""
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in placed.columns if not _has_map(placed.schema[c].dataType)]), F.lit(parts))
    placed.repartition("shard", salt).write.mode("overwrite").partitionBy("shard").parquet(path)


def _has_map(kind: T.DataType) -> bool:
    """Maps have no hash."""
    return "map<" in kind.simpleString()
