"""Plan shapes that the scale design relies on, and a hot-key case."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators.apply import apply_block
from ledgerline.operators.conflate import conflate_latest
from ledgerline.operators.maintain import compact_latest, expire_landing, reload_on_gap
from ledgerline.plans import queries as q

from core_support import SF001


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_conflation_limits_each_key_before_the_shuffle(spark):
    p = plan(q.conflate_composite(spark, SF001))
    assert "WindowGroupLimit" in p and "Partial" in p
    assert p.index("Partial") > p.index("Exchange hashpartitioning")  # partial sits below the exchange


def test_compaction_aggregates_partially_and_never_windows(spark):
    p = plan(q.compact_latest(spark, SF001))
    assert "partial_max" in p and "Window" not in p


def test_applying_a_block_scans_and_conflates_the_changes_once(spark):
    """The stored block is what the plan reads; the changes were scanned and
    shuffled by key once, when it was written."""
    for query in (q.apply_block_q, q.merge_upsert_q):
        p = plan(query(spark, SF001))
        assert "events.parquet" not in p and "Window" not in p
        assert p.count("FileScan parquet") == 3  # the table, the block's keys, the block's rows
    block = plan(q._block(q.changes(spark, SF001)))
    assert block.count("FileScan parquet") == 1 and block.count("Exchange hashpartitioning") == 1


def test_a_large_block_is_not_broadcast(spark):
    final = spark.range(1000).select(F.col("id"), F.lit("x").alias("v"))
    block = spark.range(10).select(F.col("id"), F.lit("y").alias("v"), F.lit("u").alias("ih_op"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "BroadcastHashJoin" not in plan(apply_block(final, block, ["id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_time_filters_reach_the_scan(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    p1 = plan(expire_landing(ev, dt.datetime(2024, 1, 15), ts_col="ts"))
    assert "PushedFilters: [Or(GreaterThanOrEqual(ts" in p1
    p2 = plan(reload_on_gap(ev, "ts"))
    assert p2.count("PushedFilters: [Or(GreaterThanOrEqual(ts") == 1


def test_hot_key_holding_a_third_of_rows(spark):
    n = 30_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("ih_offset"),
        F.when(F.col("id") == 29_997, F.lit("d")).otherwise(F.lit("u")).alias("ih_op"),
        F.col("id").cast("string").alias("v"),
    ).repartition(8)
    latest = conflate_latest(rows, ["k"])
    hot = latest.where("k = 0").collect()
    assert len(hot) == 1 and hot[0]["ih_offset"] == 29_997 and hot[0]["ih_op"] == "d"
    assert latest.count() == 1 + (n - n // 3)
    assert compact_latest(rows, ["k"]).where("k = 0").count() == 1
    final = spark.createDataFrame([(0, "old")], "k bigint, v string")
    assert apply_block(final, latest, ["k"]).where("k = 0").count() == 0


def test_validation_does_not_reparse_payloads(spark):
    from ledgerline.operators.validate import fail_on_invalid
    from ledgerline.sources.decode import decode_envelope

    raw = q.envelopes(spark, SF001).select(
        "topic", "partition", "offset", F.to_json("key").alias("key"), F.to_json(F.struct("before", "after", "op")).alias("value")
    )
    checked = fail_on_invalid(decode_envelope(raw, q.ROW_SCHEMA, q.KEY_SCHEMA))
    optimized = checked._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("from_json(") == 2  # one parse of the value, one of the key


def test_conflation_falls_back_to_partial_aggregate_without_group_limit(spark):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "-1")
    try:
        p = plan(q.conflate_composite(spark, SF001))
        assert "Window" not in p and "partial_max_by" in p
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_strict_conflation_is_also_limited_before_the_shuffle(spark):
    li = q.table(spark, SF001, "lineitem")
    p = plan(conflate_latest(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"], strict=True))
    assert "WindowGroupLimit" in p and "Partial" in p
    assert p.count("Exchange hashpartitioning") == 1
