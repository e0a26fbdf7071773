"""Registered queries: each operator run over the whole given tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame. Queries that
exercise sinks (staging, landing, snapshots, streams) write under the shared
work folder and return a DataFrame read back from what they wrote.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.temporal import micros_of_ntz, ntz_literal, millis_to_local_datetime, days_to_date, nanos_to_time_text
from ledgerline.operators.align import align_to_target
from ledgerline.operators.apply import apply_block, delete_by_key, merge_upsert, store_block
from ledgerline.operators.conflate import block_flags as _block_flags
from ledgerline.operators.conflate import block_metrics as _block_metrics
from ledgerline.operators.conflate import conflate_latest as _conflate_latest
from ledgerline.operators.maintain import compact_latest as _compact_latest
from ledgerline.operators.maintain import expire_landing as _expire_landing
from ledgerline.operators.maintain import reload_on_gap as _reload_on_gap
from ledgerline.operators.provenance import add_provenance as _add_provenance
from ledgerline.operators.route import plain_records as _plain_records
from ledgerline.operators.route import route_image as _route_image
from ledgerline.operators.validate import ERRORS, validate_changes as _validate_changes
from ledgerline.plans import inputs
from ledgerline.plans.inputs import changes, envelopes, seed, table
from ledgerline.session import settings, work_dir
from ledgerline.functions.text import csv_line
from ledgerline.sinks import fs
from ledgerline.sinks.staging import copy_into_landing, load_staged, stage_csv
from ledgerline.sinks.current import CurrentTable
from ledgerline.sinks.tables import ChangelogTable, LandingTable
from ledgerline.sources.changes import read_changes
from ledgerline.sources.catalog import target_columns
from ledgerline.sources.decode import decode_envelope as _decode_envelope
from ledgerline.sources.decode import decode_schemaless as _decode_schemaless

FIXED_NOW = "2024-02-01 00:00:00"
EXPIRE_NOW = "2024-01-15 00:00:00"
ROW_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
KEY_SCHEMA = T.StructType([T.StructField("id", T.LongType())])
FINAL_SCHEMA = ROW_SCHEMA
LANDING_COLUMNS = (
    "id", "type", "value", "props",
    "ih_topic", "ih_offset", "ih_partition", "ih_op", "ih_datetime", "ih_blockid",
)
N_BLOCKS = 5
GAP_DAYS = 20
LIMIT = 1_000  # records per micro-batch
# The file sink's log is rewritten whole every so many micro-batches (Spark: 10), which adds
# up to the square of their number, and listed in each, with the files of the last minutes
# (Spark: 10). A reader needs the same interval.
SINK_LOG = {"spark.sql.streaming.fileSink.log.compactInterval": "200", "spark.sql.streaming.fileSink.log.cleanupDelay": "1m"}


def _block(ch: DataFrame) -> DataFrame:
    return _conflate_latest(ch, ["id"], order_by=["ih_offset"])


# --- decode / route / project ------------------------------------------------


def decode_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = envelopes(spark, sf_dir)
    raw = env.select(
        "topic", "partition", "offset",
        F.to_json("key").alias("key"),
        F.to_json(F.struct("before", "after", "op")).alias("value"),
    )
    decoded = _decode_envelope(raw, ROW_SCHEMA, KEY_SCHEMA)
    return _route_image(decoded).select("ih_topic", "ih_partition", "ih_offset", "ih_op", "id", "type", "value", "props")


def decode_schemaless(spark: SparkSession, sf_dir: str) -> DataFrame:
    ch = changes(spark, sf_dir)
    img = F.struct(
        F.col("id").alias("ID"), F.col("type").alias("Type"), F.col("value").alias("VALUE"), F.col("props").alias("props")
    )
    op = F.col("ih_op")
    raw = ch.select(
        F.col("ih_topic").alias("topic"),
        F.col("ih_partition").alias("partition"),
        F.col("ih_offset").alias("offset"),
        F.to_json(
            F.struct(op.alias("op"), F.when(op.isin("u", "d"), img).alias("before"), F.when(op != "d", img).alias("after"))
        ).alias("value"),
    )
    decoded = _decode_schemaless(raw, cdc=True)
    rows = decoded.select(
        F.col("topic").alias("ih_topic"),
        F.col("partition").alias("ih_partition"),
        F.col("offset").alias("ih_offset"),
        F.col("op").alias("ih_op"),
        "fields",
    )
    stamped = _add_provenance(rows, variant="changelog")
    aligned = align_to_target(
        stamped,
        [("ih_offset", "string"), ("ih_op", "string"), ("id", "bigint"), ("type", "string"), ("value", "double"), ("props", "string")],
        map_col="fields",
    )
    return aligned.withColumn("k", F.get_json_object("props", "$.k")).drop("props")


def route_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = envelopes(spark, sf_dir, before_prefix="old-")
    return _route_image(env).select("ih_offset", "ih_op", "id", "type", "value")


def plain_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    recs = ev.select(
        F.lit(inputs.TOPIC).alias("topic"),
        (F.col("user_id") % 6).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        "event_id", "ts", "user_id", "event_type", "value", "props",
    )
    return _add_provenance(_plain_records(recs), variant="changelog")


def add_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    ch = changes(spark, sf_dir).drop("ih_datetime")
    return _add_provenance(ch, block_id="add_provenance-000000000000", now=FIXED_NOW)


def align_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    ch = changes(spark, sf_dir)
    src = ch.select(
        "*",
        F.floor(micros_of_ntz("ih_datetime") / 1000).cast("bigint").alias("event_time"),
        F.unix_date(F.to_date("ih_datetime")).alias("event_day"),
    )
    target = [
        ("ID", "bigint"), ("TYPE", "string"), ("Value", "double"), ("note", "string"),
        ("event_time", "timestamp_ntz"), ("event_day", "date"), ("ih_op", "string"), ("ih_offset", "bigint"),
    ]
    return align_to_target(src, target, timestamps=["event_time"], dates=[" EVENT_DAY "])


def validate_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ch = changes(spark, sf_dir)
    r = F.col("ih_offset") % 97
    op = F.col("ih_op")
    img = inputs.image()
    faulty = ch.select(
        "ih_offset",
        F.when(r == 0, F.lit(None)).otherwise(F.col("ih_topic")).alias("topic"),
        F.when((r == 1) | (F.col("ih_offset") % 89 == 1), F.lit(None)).otherwise(F.col("ih_partition")).alias("partition"),
        F.when(r == 3, F.lit(None)).otherwise(F.struct(F.when(r == 4, F.lit(None)).otherwise(F.col("id")).alias("id"))).alias("key"),
        F.when(r == 6, F.lit(None)).when((r == 5) & (op == "d"), F.lit(None)).when(op.isin("u", "d"), img).alias("before"),
        F.when(r == 6, F.lit(None)).when((r == 5) & (op != "d"), F.lit(None)).when(op != "d", img).alias("after"),
        F.when(r.isin(2, 6), F.lit(None)).otherwise(op).alias("op"),
    )
    checked = _validate_changes(faulty)
    return checked.select(
        "ih_offset",
        F.array_join(ERRORS, ",").alias("error_list"),
        F.size(ERRORS).alias("n_errors"),
    )


# --- temporal conversions ------------------------------------------------------


def convert_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    ms = F.floor(micros_of_ntz("ts") / 1000).cast("bigint")
    return ev.select("event_id", ms.alias("ts_ms"), millis_to_local_datetime(ms).alias("ts_local"))


def convert_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = table(spark, sf_dir, "orders")
    days = F.unix_date(F.to_date("o_orderdate"))
    return od.select("o_orderkey", days.alias("days"), days_to_date(days).alias("d"))


def convert_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    nanos = F.pmod(micros_of_ntz("ts"), F.lit(86_400_000_000)) * F.lit(1000)
    return ev.select("event_id", nanos.alias("nanos"), nanos_to_time_text(nanos).alias("time_text"))


# --- staging -------------------------------------------------------------------


def _landing_rows(spark: SparkSession, sf_dir: str, block: str) -> DataFrame:
    ch = changes(spark, sf_dir)
    return align_to_target(ch.withColumn("ih_blockid", F.lit(block)), list(LANDING_COLUMNS))


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _landing_rows(spark, sf_dir, "csv-000000000000")
    return rows.select("ih_offset", csv_line(rows, list(LANDING_COLUMNS)).alias("line"))


def stage_and_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a text column of the values a CSV round trip likes to lose."""
    rows = _landing_rows(spark, sf_dir, "stage-000000000000")
    kind = F.col("ih_offset") % 4
    note = F.when(kind == 0, F.lit(None)).when(kind == 1, F.lit("\u0001")).when(kind == 2, F.lit("a\r\nb")).otherwise(F.lit(""))
    rows = rows.withColumn("note", note)
    path = work_dir(spark, "stage") + "/block"
    stage_csv(rows, path)
    return load_staged(spark, path, rows.schema)


def stage_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staged block loaded into the landing table; the stage is gone after."""
    block = "purge-000000000000"
    rows = _landing_rows(spark, sf_dir, block)
    base = work_dir(spark, "purge")
    stage_csv(rows, f"{base}/stage/{block}", list(LANDING_COLUMNS))
    landing = LandingTable(spark, f"{base}/events_INGEST")
    copy_into_landing(spark, f"{base}/stage/{block}", landing, rows.schema, block_id=block)
    return landing.read(block).withColumn("stage_left", F.lit(fs.exists(spark, f"{base}/stage/{block}")))


# --- conflation ----------------------------------------------------------------


def conflate_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _block(changes(spark, sf_dir))


def conflate_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return _conflate_latest(li, ["l_orderkey", "l_linenumber"], order_by=["l_shipdate", "l_partkey", "l_suppkey"])


def block_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _block_flags(_block(changes(spark, sf_dir)))


def block_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    ch = changes(spark, sf_dir)
    return _block_metrics(ch, _block(ch))


def conflate_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of a key that moves between partitions whose offsets restart:
    the record's time, then partition and offset, say which came last."""
    from ledgerline.plans.flush import ORDER

    moved = changes(spark, sf_dir).select(
        "id", "ih_op", "type", "value",
        (F.col("ih_offset") % 3).cast("int").alias("ih_partition"),
        F.floor(F.col("ih_offset") / 3 % 500).cast("long").alias("ih_offset"),
        F.col("ih_datetime").alias(ORDER[0]),
    )
    return _conflate_latest(moved, ["id"], order_by=ORDER)


# --- applying blocks -------------------------------------------------------------


def _stored_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_block(_block(changes(spark, sf_dir, shifted=True)))


def merge_upsert_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_upsert(seed(spark, sf_dir), _stored_block(spark, sf_dir), ["id"])


def delete_by_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delete_by_key(seed(spark, sf_dir), _stored_block(spark, sf_dir), ["id"])


def apply_block_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_block(seed(spark, sf_dir), _stored_block(spark, sf_dir), ["id"])


def _blocks(df: DataFrame, col: str = "ih_offset", n: int = N_BLOCKS) -> list[DataFrame]:
    """``df`` cut into ``n`` consecutive ranges of ``col`` (one small job for
    the bounds; the ranges are literals, which reach the scan)."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    if lo is None:
        return [df] * n
    cuts = [lo + -(-(hi - lo + 1) * b // n) for b in range(n + 1)]
    return [df.where((F.col(col) >= a) & (F.col(col) < b)) for a, b in zip(cuts, cuts[1:])]


def replay_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = CurrentTable(spark, work_dir(spark, "replay") + "/final", ["id"])
    snap.initialize(seed(spark, sf_dir))
    for part in _blocks(changes(spark, sf_dir, shifted=True)):
        snap.apply(_block(part))
    return snap.read()


def _file_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_changes(spark, "parquet", path, schema, streaming=True, max_per_trigger=1_000, options={"recursiveFileLookup": "true"})


def stream_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks arrive as new files over time; each availableNow run of the same
    checkpointed query picks up exactly the block that arrived since the last
    run, so arrival order never depends on file timestamps. Within a block the
    rows of a key sit in one file (hash-partitioned by key)."""
    from ledgerline.streaming.runner import apply_stream

    ch = changes(spark, sf_dir, shifted=True)
    base = work_dir(spark, "stream")
    source = f"{base}/source"
    snap = CurrentTable(spark, f"{base}/final", ["id"])
    snap.initialize(seed(spark, sf_dir))
    for b, part in enumerate(_blocks(ch)):
        part.repartition("id").write.mode("overwrite").parquet(f"{source}/block-{b:05d}")
        apply_stream(_file_stream(spark, source, ch.schema), snap, f"{base}/checkpoint", query_name="stream_apply", keys=["id"])
    return snap.read()


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three blocks by one checkpoint, the last of them first with rows that a
    retry no longer has, then as it is, then once more, and an older one again;
    two more blocks by a new checkpoint, whose batch ids start over."""
    from ledgerline.streaming.runner import apply_stream, query_id

    ch = changes(spark, sf_dir, shifted=True)
    base = work_dir(spark, "restart")
    snap = CurrentTable(spark, f"{base}/final", ["id"])
    snap.initialize(seed(spark, sf_dir))
    parts = _blocks(ch)
    for b, part in enumerate(parts):
        source, checkpoint = (f"{base}/a", f"{base}/checkpoint-a") if b < 3 else (f"{base}/b", f"{base}/checkpoint-b")
        extra = F.when(F.col("id") % 7 == 0, F.lit("d")).otherwise(F.lit("u"))
        first = part.unionByName(part.select(*[(F.col("ih_offset") + 1 if c == "ih_offset" else extra if c == "ih_op" else F.col(c)).alias(c) for c in part.columns])) if b == 2 else part
        first.write.mode("overwrite").parquet(f"{source}/block-{b:05d}")
        apply_stream(_file_stream(spark, source, ch.schema), snap, checkpoint, query_name="stream_restart", keys=["id"])
        if b == 2:
            for _ in range(2):
                snap.apply(_block(part), query_id(spark, checkpoint), 2)
            snap.apply(_block(parts[0]), query_id(spark, checkpoint), 0)
    return snap.read()


def _flush_all(spark: SparkSession, sf_dir: str, copy_only: bool = False) -> tuple[CurrentTable, list[dict]]:
    """The whole typed-CDC flush, streamed: JSON envelope records arrive in
    blocks; each micro-batch is decoded, validated, routed, conflated,
    aligned, staged as gzip CSV, loaded into the landing table (stage purged)
    and applied to the current-state table."""
    from ledgerline.plans.flush import SinkOptions
    from ledgerline.streaming.runner import run_stream

    env = envelopes(spark, sf_dir, shifted=True)
    raw = env.select(
        "topic", "partition", "offset",
        F.to_json("key").alias("key"),
        F.to_json(F.struct("before", "after", "op")).alias("value"),
    )
    base = work_dir(spark, "flush")
    landing_schema = T.StructType(
        list(FINAL_SCHEMA.fields)
        + [
            T.StructField("ih_topic", T.StringType()), T.StructField("ih_offset", T.LongType()),
            T.StructField("ih_partition", T.IntegerType()), T.StructField("ih_op", T.StringType()),
            T.StructField("ih_datetime", T.TimestampNTZType()), T.StructField("ih_blockid", T.StringType()),
        ]
    )
    opts = SinkOptions(
        landing_schema=landing_schema, landing_path=f"{base}/events_INGEST", final_path=f"{base}/events",
        stage_path=f"{base}/stage", row_schema=ROW_SCHEMA, key_schema=KEY_SCHEMA,
        query_name="stream_flush", copy_only=copy_only,
    )
    snap = CurrentTable(spark, opts.final_path, ["id"])
    snap.initialize(seed(spark, sf_dir))
    source = f"{base}/source"
    metrics: list[dict] = []
    for b, part in enumerate(_blocks(raw, "offset")):
        part.repartition("key").write.mode("overwrite").parquet(f"{source}/block-{b:05d}")
        metrics += run_stream(spark, _file_stream(spark, source, raw.schema), opts, f"{base}/checkpoint").block_metrics
    return snap, metrics


def stream_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after every block has been flushed."""
    return _flush_all(spark, sf_dir)[0].read()


def flush_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of those flushes counted, landing only: a row per block."""
    names = ("records", "rows", "has_inserts", "has_updates", "has_deletes")
    rows = [(b, *[m[n] for n in names]) for b, m in enumerate(_flush_all(spark, sf_dir, copy_only=True)[1])]
    return spark.createDataFrame(rows, "block int, records bigint, rows bigint, has_inserts boolean, has_updates boolean, has_deletes boolean")


def stream_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog flush, streamed: schemaless CDC JSON (field names in mixed
    case) arrives in blocks; each micro-batch is decoded into a text map,
    validated, stamped (offset as text), aligned to the changelog columns
    ignoring case, and appended under its batch's block id."""
    from ledgerline.plans.flush import SinkOptions
    from ledgerline.streaming.runner import run_changelog_stream

    ch = changes(spark, sf_dir)
    img = F.struct(F.col("id").alias("ID"), F.col("type").alias("Type"), F.col("value").alias("VALUE"), F.col("props").alias("props"))
    op = F.col("ih_op")
    raw = ch.select(
        F.col("ih_topic").alias("topic"),
        F.col("ih_partition").alias("partition"),
        F.col("ih_offset").alias("offset"),
        F.to_json(F.struct(op.alias("op"), F.when(op.isin("u", "d"), img).alias("before"), F.when(op != "d", img).alias("after"))).alias("value"),
    )
    base = work_dir(spark, "changelog_stream")
    schema = T.StructType(
        list(FINAL_SCHEMA.fields)
        + [T.StructField("ih_topic", T.StringType()), T.StructField("ih_partition", T.IntegerType()),
           T.StructField("ih_offset", T.StringType()), T.StructField("ih_op", T.StringType())]
    )
    opts = SinkOptions(landing_schema=schema, landing_path=f"{base}/events_log", mode="cdc_schemaless", query_name="stream_changelog")
    for b, part in enumerate(_blocks(raw, "offset")):
        part.write.mode("overwrite").parquet(f"{base}/source/block-{b:05d}")
        run_changelog_stream(spark, _file_stream(spark, f"{base}/source", raw.schema), opts, f"{base}/checkpoint")
    return ChangelogTable(spark, opts.landing_path).read().drop("ih_blockid")


def stream_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archived log read 1,000 records at a time into Spark's own file sink,
    stopped and started again on the way; with the number of micro-batches."""
    from ledgerline.streaming.runner import append_stream

    ch = changes(spark, sf_dir).drop("ih_datetime")
    raw = ch.select(F.col("ih_topic").alias("topic"), F.col("ih_partition").alias("partition"), F.col("ih_offset").alias("offset"), "ih_op", "id", "type", "value", "props")
    base = work_dir(spark, "limited")
    for part in _blocks(raw, "offset", n=3):  # files of consecutive offsets, as a log is archived
        part.repartition("topic", "partition").sortWithinPartitions("partition", "offset").write.mode("append").partitionBy("topic", "partition").parquet(f"{base}/log")

    def start():
        stream = read_changes(spark, "change_log", f"{base}/log", raw.schema, streaming=True, max_per_trigger=LIMIT, options={"checkpointLocation": f"{base}/checkpoint"})
        named = stream.select(*[F.col(c).alias(f"ih_{c}") if c in ("topic", "partition", "offset") else F.col(c) for c in stream.columns])
        return append_stream(_add_provenance(named, variant="changelog"), f"{base}/events", f"{base}/checkpoint", "stream_limited", ["ih_partition"], {"processingTime": "0 seconds"})

    def committed() -> int:
        """By the newest commit: Spark keeps the files of the last batches alone."""
        names = [f.rsplit("/", 1)[1] for f in fs.list_files(spark, f"{base}/checkpoint/commits")]
        return max((int(n) + 1 for n in names if n.isdigit()), default=0)

    with settings(spark, SINK_LOG):
        query = start()
        while query.isActive and not committed() and not query.status["message"].startswith("Waiting"):
            time.sleep(0.05)
        query.stop()
        query = start()
        query.processAllAvailable()
        query.stop()
        return spark.read.parquet(f"{base}/events").withColumn("batches", F.lit(committed()))


def stream_file_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changelog rows by Spark's own file sink, partitioned, from files that
    arrive between runs of one checkpoint."""
    from ledgerline.streaming.runner import append_stream

    ch = changes(spark, sf_dir).drop("ih_datetime")
    base = work_dir(spark, "file_sink")
    for b, part in enumerate(_blocks(ch)):
        part.write.mode("overwrite").parquet(f"{base}/source/block-{b:05d}")
        rows = _add_provenance(_file_stream(spark, f"{base}/source", ch.schema), variant="changelog")
        query = append_stream(rows, f"{base}/events", f"{base}/checkpoint", "stream_file_sink", ["ih_partition"])
        query.awaitTermination()
    return spark.read.parquet(f"{base}/events")


def stream_gap_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changelog flushes by a clock that stands still for 31 minutes before the
    third of five blocks: the table is emptied and loaded in one step."""
    from ledgerline.plans.flush import SinkOptions
    from ledgerline.streaming.runner import run_changelog_stream

    ch = changes(spark, sf_dir)
    raw = ch.select(
        F.col("ih_topic").alias("topic"), F.col("ih_partition").alias("partition"), F.col("ih_offset").alias("offset"),
        F.to_json(F.struct(F.col("id").alias("ID"), F.col("type").alias("TYPE"))).alias("value"),
    )
    base = work_dir(spark, "gap_stream")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("type", T.StringType()), T.StructField("ih_offset", T.StringType())])
    opts = SinkOptions(
        landing_schema=schema, landing_path=f"{base}/events_log", mode="schemaless", query_name="stream_gap_reload", reload_gap_seconds=1800, reload_after_outage=True)
    minutes = (0, 10, 41, 60, 90)
    for b, part in enumerate(_blocks(raw, "offset")):
        part.write.mode("overwrite").parquet(f"{base}/source/block-{b:05d}")
        now = _dt.datetime(2024, 1, 1) + _dt.timedelta(minutes=minutes[b])
        run_changelog_stream(spark, _file_stream(spark, f"{base}/source", raw.schema), opts, f"{base}/checkpoint", clock=lambda now=now: now)
    return ChangelogTable(spark, opts.landing_path).read().drop("ih_blockid")


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a listener saw of each micro-batch: records read, rows, upserts and
    deletes written, and failed upkeep runs (one fails, after the second)."""
    from ledgerline.streaming.progress import FlushProgress, counted
    from ledgerline.streaming.runner import Maintenance, append_stream

    ch = changes(spark, sf_dir).drop("ih_datetime")
    base = work_dir(spark, "progress")
    missing = ChangelogTable(spark, f"{base}/log")
    missing.append(ch.limit(0).withColumn("id", F.lit(None).cast("long")), "none")
    upkeep = Maintenance(None, "PT1H", changelog=missing, keys=["no_such_column"])
    name = f"stream_progress_{base.rsplit('-', 1)[1]}"
    progress = FlushProgress(name, upkeep)
    spark.streams.addListener(progress)
    try:
        for b, part in enumerate(_blocks(ch)):
            part.write.mode("overwrite").parquet(f"{base}/source/block-{b:05d}")
            rows = counted(_add_provenance(_file_stream(spark, f"{base}/source", ch.schema), variant="changelog"))
            append_stream(rows, f"{base}/events", f"{base}/checkpoint", name).awaitTermination()
            until = time.monotonic() + 60  # reports come on a thread of their own
            while b not in progress.batches and time.monotonic() < until:
                time.sleep(0.05)
            if b == 1:
                missing.append(ch, "all")
                upkeep.maybe_run(_dt.datetime.fromisoformat(EXPIRE_NOW))
    finally:
        spark.streams.removeListener(progress)
    rows = [(b, *[m[k] for k in ("records", "rows", "upserts", "deletes", "failures")]) for b, m in sorted(progress.batches.items())]
    return spark.createDataFrame(rows, "batch int, records bigint, rows bigint, upserts bigint, deletes bigint, failures int")


def _catalog_table(spark: SparkSession, name: str, schema: T.StructType, partition_by=()):
    """A managed table in a database of its own under the work folder."""
    from ledgerline.sinks.catalog_table import CatalogTable

    base = work_dir(spark, name)
    database = f"ll_{name}_{base.rsplit('-', 1)[1]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}/db'")
    table = CatalogTable(spark, f"{database}.events_INGEST")
    table.create(schema, partition_by)
    return table, base


def catalog_copy_into(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staged block loaded into a catalog table by its column list; the table
    has the columns in another order, and one more."""
    rows = _landing_rows(spark, sf_dir, "catalog-000000000000")
    wider = T.StructType([T.StructField("note", T.StringType()), *reversed(rows.schema.fields)])
    target, base = _catalog_table(spark, "copy_into", wider)
    stage_csv(rows, f"{base}/stage")
    target.copy_into(f"{base}/stage", rows.schema)
    return target.read().withColumn("stage_left", F.lit(fs.exists(spark, f"{base}/stage")))


def catalog_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks loaded into a catalog table partitioned by op; emptied after the
    first; the partition of deletes dropped at the end."""
    ch = changes(spark, sf_dir).drop("ih_datetime")
    target, _ = _catalog_table(spark, "catalog", ch.schema, ["ih_op"])
    for b, part in enumerate(_blocks(ch, n=2)):
        if b:
            target.truncate()
        target.load(part)
    target.drop_partition(ih_op="d")
    return target.read()


def metadata_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes aligned to upper-cased columns from driver metadata, in which a
    name comes twice."""
    listed = T.StructType([T.StructField(n, T.StringType()) for n in ("type", "id", "ih_offset", "id", "value", "type")])
    return align_to_target(changes(spark, sf_dir), target_columns(spark, listed, ignore=["VALUE"], distinct=True, upper=True))


def stamp_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provenance with the clock of the run: one time for the whole block, in
    UTC, between the start and the end of the write."""
    rows = _add_provenance(changes(spark, sf_dir).drop("ih_datetime"), block_id="now-000000000000")
    landing = LandingTable(spark, work_dir(spark, "now") + "/events_INGEST")
    before = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    landing.land(rows, "now-000000000000")
    after = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    landed = landing.read()
    times = landed.agg(F.count_distinct("ih_datetime").alias("times"))
    within = F.col("ih_datetime").between(ntz_literal(before), ntz_literal(after))
    return landed.crossJoin(F.broadcast(times)).select("ih_offset", "ih_blockid", within.alias("within"), "times")


def wide_schemaless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemaless records of 300 fields, names in mixed case, some twice, looked
    up in one pass; every hundredth column comes back."""
    from ledgerline.plans.flush import SinkOptions, prepare_changelog

    ch = changes(spark, sf_dir)
    many = [(F.col("id") * k).cast("string").alias(f"Field_{k}") for k in range(300)]
    last = F.concat(F.lit("last-"), "type").alias("FIELD_200")
    both = ch.select("ih_topic", "ih_partition", "ih_offset", F.to_json(F.struct(*many)).alias("payload"), F.to_json(F.struct(last)).alias("extra"))
    raw = both.select(
        F.col("ih_topic").alias("topic"), F.col("ih_partition").alias("partition"), F.col("ih_offset").alias("offset"),
        # bytes are cut in one step, characters are counted first
        F.expr("cast(concat(substring(cast(payload as binary), 1, octet_length(payload) - 1), cast(',' as binary), substring(cast(extra as binary), 2, octet_length(extra) - 1)) as string)").alias("value"),
    )
    schema = T.StructType([T.StructField(f"field_{k}", T.StringType()) for k in range(300)] + [T.StructField("missing", T.StringType()), T.StructField("ih_offset", T.StringType())])
    aligned = prepare_changelog(raw, SinkOptions(landing_schema=schema, landing_path="", mode="schemaless"))
    return aligned.select("ih_offset", "field_1", "field_100", "field_200", "field_299", "missing")


def schemaless_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemaless records whose payload has a field named like a column of the
    record itself: the payload's value is the row's."""
    from ledgerline.plans.flush import SinkOptions, prepare_changelog

    ch = changes(spark, sf_dir)
    millis = F.floor(micros_of_ntz("ih_datetime") / 1000).cast("bigint")
    raw = ch.select(
        F.col("ih_topic").alias("topic"), F.col("ih_partition").alias("partition"), F.col("ih_offset").alias("offset"),
        F.lit("1999-01-01 00:00:00").cast("timestamp_ntz").alias("timestamp"),
        F.to_json(F.struct(F.col("id").alias("ID"), millis.alias("timestamp"), F.col("type").alias("topic"))).alias("value"),
    )
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("timestamp", T.TimestampNTZType()), T.StructField("topic", T.StringType()),
         T.StructField("ih_topic", T.StringType()), T.StructField("ih_offset", T.StringType())]
    )
    opts = SinkOptions(landing_schema=schema, landing_path="", mode="schemaless", timestamps=["timestamp"])
    return prepare_changelog(raw, opts)


def discover_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All changes aligned to the columns that the catalog lists for a target
    table, less the ignored ones."""
    from ledgerline.plans.flush import SinkOptions

    ch = changes(spark, sf_dir)
    target = ch.select("id", "value", "props", "type", "ih_offset").schema
    view = f"ll_discovered_{uuid.uuid4().hex}_INGEST"
    spark.createDataFrame([], target).createOrReplaceTempView(view)
    opts = SinkOptions.discover(spark, view, landing_path="", ignore_columns=["props", "TYPE"], distinct=True)
    return align_to_target(ch, opts.landing_schema)


# --- sinks -----------------------------------------------------------------------


def land_block_copy_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = "land-000000000000"
    rows = _block(changes(spark, sf_dir))
    landed = align_to_target(_add_provenance(rows, block_id=block, now=FIXED_NOW), list(LANDING_COLUMNS))
    landing = LandingTable(spark, work_dir(spark, "landing") + "/events_INGEST")
    landing.land(landed)
    landing.land(landed)
    return landing.read(block).select(*LANDING_COLUMNS)


def append_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    ch = changes(spark, sf_dir).drop("ih_datetime")
    rows = _add_provenance(ch, variant="changelog")
    log = ChangelogTable(spark, work_dir(spark, "changelog") + "/events")
    log.append(rows, "changelog-000000000000")
    log.append(rows, "changelog-000000000000")
    return log.read().drop("ih_blockid")


def truncate_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks appended, the table emptied in between: the last one is left."""
    log = ChangelogTable(spark, work_dir(spark, "truncate") + "/events")
    for b, part in enumerate(_blocks(changes(spark, sf_dir), n=2)):
        if b:
            log.truncate()
        log.append(_add_provenance(part.drop("ih_datetime"), variant="changelog"), f"truncate-{b:012d}")
    return log.read().drop("ih_blockid")


# --- maintenance -----------------------------------------------------------------


def expire_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retention of a stored table, run by the upkeep between batches."""
    from ledgerline.streaming.runner import Maintenance

    landing = LandingTable(spark, work_dir(spark, "expire") + "/events_INGEST")
    for b, part in enumerate(_blocks(changes(spark, sf_dir))):
        landing.land(part, f"expire-{b:012d}")
    Maintenance(landing, "PT4H").maybe_run(_dt.datetime.fromisoformat(EXPIRE_NOW))
    return landing.read().drop("ih_blockid")


def compact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The compaction of a stored changelog, run by the upkeep between batches."""
    from ledgerline.streaming.runner import Maintenance

    log = ChangelogTable(spark, work_dir(spark, "compact") + "/events")
    for b, part in enumerate(_blocks(changes(spark, sf_dir))):
        log.append(part, f"compact-{b:012d}")
    Maintenance(None, "PT4H", changelog=log, keys=["id"]).maybe_run(_dt.datetime.fromisoformat(EXPIRE_NOW))
    return log.read().drop("ih_blockid")


def reload_on_gap_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gap of more than a day: arrivals spread over months, so that quiet
    days lie between busy ones."""
    ev = table(spark, sf_dir, "events")
    ev = ev.select("event_id", "user_id", _spread_out("ts").alias("moved_ts"))
    return _reload_on_gap(ev, "moved_ts", gap_seconds=GAP_DAYS * 86_400)


def _spread_out(ts: str):
    """Day ``d`` of a month moved back by ``(30 - d)^2`` days: the quiet spells
    between busy days shrink from weeks to a day."""
    left = F.lit(30) - F.dayofmonth(ts)
    return F.timestamp_add("DAY", (-left * left).cast("int"), F.col(ts))


def expire_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expire_landing(changes(spark, sf_dir), _dt.datetime.fromisoformat(EXPIRE_NOW))


def compact_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compact_latest(changes(spark, sf_dir), ["id"])


def reload_on_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reload_on_gap(table(spark, sf_dir, "events"), "ts", gap_seconds=1800)


QUERIES = {
    "decode_envelope": decode_envelope,
    "decode_schemaless": decode_schemaless,
    "route_image": route_image,
    "plain_records": plain_records,
    "add_provenance": add_provenance,
    "align_to_target": align_target,
    "validate_changes": validate_changes,
    "convert_timestamp": convert_timestamp,
    "convert_date": convert_date,
    "convert_time": convert_time,
    "csv_lines": csv_lines,
    "stage_and_load": stage_and_load,
    "stage_purge": stage_purge,
    "conflate_latest": conflate_latest,
    "conflate_composite": conflate_composite,
    "conflate_arrival": conflate_arrival,
    "block_flags": block_flags,
    "block_metrics": block_metrics,
    "merge_upsert": merge_upsert_q,
    "delete_by_key": delete_by_key_q,
    "apply_block": apply_block_q,
    "replay_blocks": replay_blocks,
    "stream_apply": stream_apply,
    "stream_restart": stream_restart,
    "stream_flush": stream_flush,
    "flush_counters": flush_counters,
    "stream_changelog": stream_changelog,
    "stream_limited": stream_limited,
    "stream_file_sink": stream_file_sink,
    "stream_gap_reload": stream_gap_reload,
    "stream_progress": stream_progress,
    "catalog_copy_into": catalog_copy_into,
    "catalog_truncate": catalog_truncate,
    "metadata_columns": metadata_columns,
    "stamp_now": stamp_now,
    "wide_schemaless": wide_schemaless,
    "schemaless_timestamp": schemaless_timestamp,
    "discover_columns": discover_columns,
    "land_block_copy_only": land_block_copy_only,
    "append_changelog": append_changelog,
    "truncate_changelog": truncate_changelog,
    "expire_landing": expire_landing,
    "expire_table": expire_table,
    "compact_latest": compact_latest,
    "compact_table": compact_table,
    "reload_on_gap": reload_on_gap,
    "reload_on_gap_days": reload_on_gap_days,
}