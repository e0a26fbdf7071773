"""Change records of a small order book, from envelope to target columns.

Expected values follow from the rules: the last change of a key wins, a delete
takes the image before it, listed columns are converted from epoch millis,
epoch days and nanos of day, and text fields are quoted with quotes doubled.
"""

import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.text import csv_line
from ledgerline.operators.align import align_to_target
from ledgerline.operators.conflate import conflate_latest
from ledgerline.operators.provenance import add_provenance
from ledgerline.operators.route import RECORD_TIME, route_image
from ledgerline.operators.validate import fail_on_invalid, validate_changes
from ledgerline.plans.flush import ORDER
from ledgerline.sources.catalog import final_columns, target_columns
from ledgerline.sources.decode import decode_envelope

ORDER_ROW = T.StructType([
    T.StructField("OrderNo", T.LongType()), T.StructField("Customer", T.StringType()), T.StructField("placed", T.LongType()),
    T.StructField("ready", T.LongType()), T.StructField("due", T.IntegerType()),
])
ORDER_KEY = T.StructType([T.StructField("OrderNo", T.LongType())])
BOOK = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()), T.StructField("key", ORDER_KEY),
    T.StructField("value", T.StructType([T.StructField("before", ORDER_ROW), T.StructField("after", ORDER_ROW), T.StructField("op", T.StringType())])),
])
NOON = dt.datetime(2031, 5, 4, 12)


def order(number, customer, placed=None, ready=None, due=None):
    return (number, customer, placed, ready, due)


def change(op, number, customer="ada", at=0, partition=0, offset=0, topic="shop.orders", **fields):
    row = order(number, customer, **fields)
    return (topic, partition, offset, NOON + dt.timedelta(seconds=at), (number,), (row if op in "ud" else None, row if op != "d" else None, op))


def last_changes(spark, rows, order_by=ORDER):
    routed = route_image(decode_envelope(spark.createDataFrame(rows, BOOK)))
    return {r["OrderNo"]: (r["ih_op"], r["Customer"]) for r in conflate_latest(routed, ["ih_key"], order_by=order_by).collect()}


def test_record_time_orders_a_key_that_moved_to_another_partition(spark):
    rows = [
        change("c", 7, "early", at=1, partition=0, offset=900),
        change("u", 7, "late", at=2, partition=3, offset=5),
        change("c", 8, "kept", at=9, offset=2),
        change("c", 9, "gone", at=3, offset=41),
        change("d", 9, "gone", at=4, offset=0),
    ]
    assert last_changes(spark, rows) == {7: ("u", "late"), 8: ("c", "kept"), 9: ("d", "gone")}


def test_equal_times_fall_back_to_partition_and_offset(spark):
    rows = [change("c", 1, "a", offset=10), change("u", 1, "b", offset=12), change("u", 1, "c", offset=11)]
    assert last_changes(spark, rows) == {1: ("u", "b")}
    assert RECORD_TIME == ORDER[0]


def test_winner_of_tied_changes_never_depends_on_the_run(spark):
    rows = [("k", 1, f"v{i}") for i in range(50)]
    winners = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame(rows, "k string, ih_offset bigint, v string").repartition(parts)
        winners.add(conflate_latest(df, ["k"]).first()["v"])
        winners.add(conflate_latest(df, ["k"], method="aggregate").first()["v"])
    assert len(winners) == 1


def found(spark, rows):
    checked = validate_changes(decode_envelope(spark.createDataFrame(rows, BOOK)))
    return {r["offset"]: r["errors"] for r in checked.collect()}


def test_each_missing_part_is_named(spark):
    whole = change("u", 4, offset=0)

    def without(offset, part, value=None):
        row = list(whole)
        row[2], row[part] = offset, value
        return tuple(row)

    image = whole[5][0]
    rows = [
        whole, without(1, 0), without(2, 1), without(3, 4), without(4, 4, (None,)), without(5, 5),
        without(6, 5, (image, image, None)), without(7, 5, (image, None, "u")), without(8, 5, (None, image, "d")),
    ]
    assert found(spark, rows) == {
        0: [], 1: ["topic_null"], 2: ["partition_null"], 3: ["key_not_struct"], 4: ["pk_null:OrderNo"], 5: ["value_not_struct"],
        6: ["op_null"], 7: ["image_null"], 8: ["image_null"],
    }
    with pytest.raises(Exception, match="invalid change record: topic_null"):
        fail_on_invalid(decode_envelope(spark.createDataFrame([whole, without(1, 0)], BOOK))).collect()


def test_text_payloads_that_do_not_parse(spark):
    good_key, good = '{"OrderNo": 3}', '{"after": {"OrderNo": 3, "Customer": "bo"}, "op": "C"}'
    raw = spark.createDataFrame(
        [(0, good_key, good), (1, good_key, "{"), (2, "{", good), (3, good_key, None)], "offset bigint, key string, value string"
    ).withColumns({"topic": F.lit("shop.orders"), "partition": F.lit(1)})
    out = validate_changes(decode_envelope(raw, ORDER_ROW, ORDER_KEY))
    assert {r["offset"]: r["errors"] for r in out.collect()} == {0: [], 1: ["value_not_struct"], 2: ["key_not_struct"], 3: ["value_not_struct"]}
    assert [r["op"] for r in out.where("offset = 0").collect()] == ["c"]
    as_bytes = raw.where("offset = 0").select("topic", "partition", "offset", F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    row = route_image(decode_envelope(as_bytes, ORDER_ROW, ORDER_KEY)).first()
    assert (row["OrderNo"], row["Customer"], row["ih_op"]) == (3, "bo", "c")


def test_an_envelope_without_op_is_a_plan_error(spark):
    schema = T.StructType([*BOOK.fields[:5], T.StructField("value", T.StructType([T.StructField("after", ORDER_ROW)]))])
    df = spark.createDataFrame([("shop.orders", 0, 0, NOON, (1,), (order(1, "ada"),))], schema)
    with pytest.raises(ValueError, match="op"):
        decode_envelope(df)


TARGET = ["ORDERNO", "customer", "Placed", "READY", "due", "shelf", "ih_topic", "ih_offset", "ih_partition", "ih_op", "ih_datetime", "ih_blockid"]
PLACED = dt.datetime(2031, 1, 1, 0, 15, tzinfo=dt.timezone.utc)
DUE = dt.date(2031, 1, 9)


def lines(spark, zone="UTC", date_mode="true"):
    made = dict(placed=int(PLACED.timestamp() * 1000), ready=(6 * 3600 + 5 * 60) * 10**9, due=(DUE - dt.date(1970, 1, 1)).days)
    rows = [change("c", 11, 'the "inn"', offset=70, **made), change("d", 12, "", offset=71, **made)]
    routed = route_image(decode_envelope(spark.createDataFrame(rows, BOOK)))
    stamped = add_provenance(routed, block_id="shop-3", now=NOON)
    out = align_to_target(stamped, TARGET, timestamps=["PLACED"], dates=[" due"], times=["Ready"], zone=zone, date_mode=date_mode)
    return sorted(r[0] for r in out.select(csv_line(out)).collect())


@pytest.mark.parametrize("zone, date_mode", [("UTC", "true"), ("Pacific/Auckland", "true"), ("America/Sao_Paulo", "zoned")])
def test_lines_of_converted_columns(spark, zone, date_mode):
    local = PLACED.astimezone(ZoneInfo(zone)).strftime("%Y-%m-%dT%H:%M")
    due = DUE
    if date_mode == "zoned":  # the date of that day's midnight UTC in the zone
        due = dt.datetime(DUE.year, DUE.month, DUE.day, tzinfo=dt.timezone.utc).astimezone(ZoneInfo(zone)).date()
    tail = '"shop.orders","{}","0","{}","2031-05-04T12:00","shop-3"'
    assert lines(spark, zone, date_mode) == [
        f'"11","the ""inn""","{local}","06:05","{due}",,' + tail.format(70, "c"),
        f'"12","","{local}","06:05","{due}",,' + tail.format(71, "d"),
    ]


def test_target_and_final_columns(spark):
    def schema(*names):
        return T.StructType([T.StructField(n, T.StringType()) for n in names])

    book = schema("no", "Note", "IH_OP", "ih_topic", "ih_partition", "ih_offset", "ih_datetime", "ih_blockid")
    assert target_columns(spark, book) == book.names
    assert final_columns(book.names) == ["no", "Note"]
    assert target_columns(spark, book, ignore=["Note", "IH_TOPIC"]) == ["no", *book.names[2:]]
    assert target_columns(spark, schema("a", "b"), distinct=True) == ["a", "b"]
    with pytest.raises(ValueError, match="empty"):
        target_columns(spark, schema())
    spark.createDataFrame([(1, "x")], "no bigint, Note string").createOrReplaceTempView("book_target")
    assert target_columns(spark, "book_target", upper=True) == ["NO", "NOTE"]
