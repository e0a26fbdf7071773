"""Edge cases (FIXTURES.md section 7) for single operators."""

import datetime as dt

import pytest

from ledgerline.functions.ids import block_id
from ledgerline.functions.temporal import days_to_date, millis_to_local_datetime, nanos_to_time_text, whole_minutes_between
from ledgerline.operators.align import align_to_target
from ledgerline.operators.apply import apply_block
from ledgerline.operators.conflate import conflate_latest
from ledgerline.operators.maintain import compact_latest, expire_landing, parse_interval, reload_on_gap
from ledgerline.sources.decode import decode_schemaless, entry_lookup, lowered_entries


def test_composite_keys_are_not_joined_strings(spark):
    df = spark.createDataFrame([("a+b", "c", 1, "x"), ("a", "b+c", 2, "y")], "k1 string, k2 string, ih_offset bigint, v string")
    assert conflate_latest(df, ["k1", "k2"]).count() == 2


def test_conflate_methods_agree_and_strict_detects_ties(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (2, 5, "d")], "id int, ih_offset bigint, v string")
    for m in ("window", "aggregate"):
        assert sorted(conflate_latest(df, ["id"], method=m).select("id", "v").collect()) == [(1, "b"), (2, "d")]
    assert sorted(conflate_latest(df, ["id"], strict=True).select("id", "v").collect()) == [(1, "b"), (2, "d")]
    tied = spark.createDataFrame([(1, 3, "a"), (1, 3, "b")], "id int, ih_offset bigint, v string")
    with pytest.raises(Exception, match="tied"):
        conflate_latest(tied, ["id"], strict=True).collect()


def test_upper_case_delete_and_unknown_op(spark):
    from ledgerline.operators.route import route_image
    from ledgerline.sources.decode import decode_envelope

    row = "struct<id:bigint,v:string>"
    raw = spark.createDataFrame(
        [
            ("t", 0, 1, '{"id":1}', '{"before":{"id":1,"v":"old"},"op":"D"}'),
            ("t", 0, 2, '{"id":2}', '{"after":{"id":2,"v":"new"},"op":"c"}'),
            ("t", 0, 3, '{"id":2}', '{"after":{"id":2,"v":"odd"},"op":"t"}'),
        ],
        "topic string, partition int, offset bigint, key string, value string",
    )
    from pyspark.sql.types import _parse_datatype_string

    dec = decode_envelope(raw, _parse_datatype_string(row), _parse_datatype_string("struct<id:bigint>"))
    block = conflate_latest(route_image(dec), ["id"])
    ops = {r["id"]: r["ih_op"] for r in block.collect()}
    assert ops == {1: "d", 2: "t"}
    final = spark.createDataFrame([(1, "old"), (2, "keep")], "id bigint, v string")
    assert sorted(apply_block(final, block, ["id"]).collect()) == [(2, "keep")]


def test_apply_keeps_null_keys_and_replaces_whole_rows(spark):
    final = spark.createDataFrame([(None, "n"), (1, "a"), (2, "b")], "id bigint, v string")
    block = spark.createDataFrame([(1, None, "u"), (3, "c", "c"), (2, None, "d")], "id bigint, v string, ih_op string")
    assert sorted(apply_block(final, block, ["id"]).collect(), key=str) == sorted([(None, "n"), (1, None), (3, "c")], key=str)


def test_temporal_edges(spark):
    df = spark.createDataFrame(
        [(0, 29220, 0), (1, -1, 86_399_999_999_999), (2, 0, 37_800_000_000_000), (3, 0, 37_840_500_000_000), (4, 0, 37_840_000_001_000), (5, 0, 37_840_000_000_001), (6, 0, 86_400_000_000_000)],
        "i int, d int, n bigint",
    )
    out = df.select("i", days_to_date("d").alias("d"), nanos_to_time_text("n").alias("t")).orderBy("i").collect()
    assert [r["d"] for r in out[:2]] == [dt.date(2050, 1, 1), dt.date(1969, 12, 31)]
    assert [r["t"] for r in out] == ["00:00", "23:59:59.999999999", "10:30", "10:30:40.500", "10:30:40.000001", "10:30:40.000000001", None]


def test_millis_zone_and_minutes(spark):
    df = spark.createDataFrame([(1515580240000,)], "ms bigint")
    r = df.select(millis_to_local_datetime("ms").alias("u"), millis_to_local_datetime("ms", "America/Sao_Paulo").alias("s")).first()
    assert r["u"] == dt.datetime(2018, 1, 10, 10, 30, 40)
    assert r["s"] == dt.datetime(2018, 1, 10, 8, 30, 40)
    gaps = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 0, 30, 59)), (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 31))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert [r[0] for r in gaps.select(whole_minutes_between("a", "b")).collect()] == [30, 31]


def test_schemaless_case_collisions(spark):
    df = spark.createDataFrame([('{"Id": "1", "ID": "2", "name": "x"}',)], "value string")
    dec = decode_schemaless(df, cdc=False)
    assert dec.select(entry_lookup(lowered_entries("fields"), "id")).first()[0] == "2"
    typed = spark.createDataFrame([("1", "2")], "Id string, ID string")
    with pytest.raises(Exception):
        typed.select("id").collect()
    assert align_to_target(typed, [("id", "string")]).first()[0] == "1"


def test_compaction_keeps_ties_nulls_and_tombstones(spark):
    df = spark.createDataFrame(
        [(1, 5, "u"), (1, 7, "d"), (2, 3, "c"), (2, 3, "u"), (None, 1, "c"), (None, 2, "c"), (3, None, "c"), (3, 4, "u")],
        "id bigint, ih_offset bigint, ih_op string",
    )
    out = sorted(compact_latest(df, ["id"]).collect(), key=str)
    assert out == sorted([(1, 7, "d"), (2, 3, "c"), (2, 3, "u"), (None, 1, "c"), (None, 2, "c"), (3, None, "c"), (3, 4, "u")], key=str)
    assert sorted(compact_latest(compact_latest(df, ["id"]), ["id"]).collect(), key=str) == out


def test_retention_boundaries(spark):
    now = dt.datetime(2024, 1, 15, 12, 0, 0)
    df = spark.createDataFrame(
        [(1, now - dt.timedelta(hours=4)), (2, now - dt.timedelta(hours=4, microseconds=1)), (3, None), (4, now)],
        "id int, ih_datetime timestamp_ntz",
    )
    assert sorted(r[0] for r in expire_landing(df, now).collect()) == [1, 3, 4]
    assert parse_interval("PT3M") == dt.timedelta(minutes=3)
    assert parse_interval("4 hours") == dt.timedelta(hours=4)


@pytest.mark.parametrize(
    "gap, reloads",
    [(dt.timedelta(minutes=30, seconds=59), False), (dt.timedelta(minutes=31), True), (dt.timedelta(minutes=31, seconds=1), True)],
)
def test_reload_gap_boundaries(spark, gap, reloads):
    t0 = dt.datetime(2024, 1, 1, 23, 50)
    rows = [(1, t0), (2, t0 + dt.timedelta(minutes=5)), (3, t0 + dt.timedelta(minutes=5) + gap), (4, t0 + dt.timedelta(minutes=6) + gap)]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    kept = sorted(r[0] for r in reload_on_gap(df, "ts").collect())
    assert kept == ([3, 4] if reloads else [1, 2, 3, 4])


def test_reload_gap_across_days_and_within_minute(spark):
    rows = [(1, dt.datetime(2024, 1, 1, 23, 59, 59)), (2, dt.datetime(2024, 1, 2, 0, 40)), (3, dt.datetime(2024, 1, 2, 0, 40, 30))]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    assert sorted(r[0] for r in reload_on_gap(df, "ts").collect()) == [2, 3]


def test_reload_gap_over_an_empty_calendar_day(spark):
    rows = [(1, dt.datetime(2024, 1, 1, 10, 0)), (2, dt.datetime(2024, 1, 3, 9, 0)), (3, dt.datetime(2024, 1, 3, 9, 5))]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    assert sorted(r[0] for r in reload_on_gap(df, "ts").collect()) == [2, 3]
    single = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 10, 0)), (2, dt.datetime(2024, 1, 1, 10, 20))], "id int, ts timestamp_ntz")
    assert sorted(r[0] for r in reload_on_gap(single, "ts").collect()) == [1, 2]


def test_block_id_is_deterministic():
    assert block_id("orders sink", 7) == block_id("orders sink", 7) == "orders_sink-000000000007"


def test_schemaless_cdc_validation(spark):
    from ledgerline.operators.validate import schemaless_reasons

    raw = spark.createDataFrame(
        [
            ("t", 0, '{"op": "c", "after": {"id": 1}}'),
            ("t", 0, '{"after": {"id": 1}}'),
            ("t", 0, '{"op": "d", "after": {"id": 1}}'),
            (None, 0, '{"op": "u", "after": {"id": 1}}'),
        ],
        "topic string, partition int, value string",
    )
    dec = decode_schemaless(raw, cdc=True)
    out = [r[0] for r in dec.select(schemaless_reasons(dec)).collect()]
    assert out == [[], ["op_null"], ["image_null"], ["topic_null"]]


def test_compaction_of_text_offsets_is_numeric(spark):
    df = spark.createDataFrame([(1, "9", "u"), (1, "10", "d"), (2, "x", "c")], "id bigint, ih_offset string, ih_op string")
    assert sorted(tuple(r) for r in compact_latest(df, ["id"]).collect()) == [(1, "10", "d"), (2, "x", "c")]


def test_merge_into_table_is_well_formed_and_needs_a_row_level_table(spark):
    from ledgerline.operators.apply import merge_into_table

    spark.createDataFrame([(1, "a")], "id bigint, v string").write.mode("overwrite").saveAsTable("merge_target")
    block = spark.createDataFrame([(1, "b", "u"), (2, "c", "c"), (3, None, "d")], "id bigint, v string, ih_op string")
    with pytest.raises(Exception, match="does not support MERGE INTO TABLE"):
        merge_into_table(block, "merge_target", ["id"], ["id", "v"])


def test_conflation_with_dotted_column_names(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "`k.id` int, `ih.offset` bigint, v string")
    for m in ("window", "aggregate"):
        assert [r["v"] for r in conflate_latest(df, ["k.id"], order_by=["ih.offset"], method=m).collect()] == ["b"]
