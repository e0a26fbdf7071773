"""Inputs derived from the given tables.

``changes``: the ``events`` table read as a change log. One topic; a user
stays in one partition (``user_id % 6``); the event id is the offset, unique
and in time order; the event type decides the op (signup creates, view is a
snapshot read, error deletes, the rest update).

``shifted`` changes move the key of every fifth user past all customers, so
that a block applied to the seed also inserts, and deletes what is not there.

``seed``: the current-state table before the changes, every customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC = "cdc.test.events"
SHIFT = 1_000_000_000_000
FINAL_COLUMNS = ("id", "type", "value", "props")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op_of(event_type) -> F.Column:
    et = F.col(event_type) if isinstance(event_type, str) else event_type
    return (
        F.when(et == "signup", "c")
        .when(et == "view", "r")
        .when(et == "error", "d")
        .otherwise("u")
    )


def changes(spark: SparkSession, sf_dir: str, shifted: bool = False) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    user = F.col("user_id")
    key = F.when(user % 5 == 0, user + SHIFT).otherwise(user) if shifted else user
    return ev.select(
        F.lit(TOPIC).alias("ih_topic"),
        (F.col("user_id") % 6).cast("int").alias("ih_partition"),
        F.col("event_id").alias("ih_offset"),
        op_of("event_type").alias("ih_op"),
        F.col("ts").alias("ih_datetime"),
        key.alias("id"),
        F.col("event_type").alias("type"),
        F.col("value"),
        F.col("props"),
    )


def seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    return cust.select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("type"),
        F.col("c_acctbal").alias("value"),
        F.lit(None).cast("string").alias("props"),
    )


def image(prefix_type: str | None = None) -> F.Column:
    """The row image of a change as a struct."""
    t = F.col("type") if prefix_type is None else F.concat(F.lit(prefix_type), F.col("type"))
    return F.struct(F.col("id").alias("id"), t.alias("type"), F.col("value").alias("value"), F.col("props").alias("props"))


def envelopes(spark: SparkSession, sf_dir: str, before_prefix: str | None = None, shifted: bool = False) -> DataFrame:
    """Changes as records: position, key struct, and a before/after/op envelope.

    Creates and snapshot reads have no ``before``; deletes have no ``after``.
    """
    ch = changes(spark, sf_dir, shifted)
    op = F.col("ih_op")
    return ch.select(
        F.col("ih_topic").alias("topic"),
        F.col("ih_partition").alias("partition"),
        F.col("ih_offset").alias("offset"),
        F.struct(F.col("id").alias("id")).alias("key"),
        F.when(op.isin("u", "d"), image(before_prefix)).alias("before"),
        F.when(op != "d", image()).alias("after"),
        op.alias("op"),
    )
