"""Structured Streaming: file stream -> foreachBatch flushes, restart safety."""

import datetime as dt
import json

from pyspark.sql import functions as F

from ledgerline.plans.flush import SinkOptions
from ledgerline.sinks.current import CurrentTable
from ledgerline.sinks.tables import ChangelogTable, LandingTable
from ledgerline.streaming.runner import run_changelog_stream, run_stream

from test_tables import KEY, LANDING, ROW, raw_records

RAW_SCHEMA = "topic string, partition int, offset bigint, key string, value string"


def _write_batches(spark, root, batches):
    for i, recs in enumerate(batches):
        df = raw_records(spark, recs).withColumn("offset", F.col("offset") + F.lit(100 * i))
        df.coalesce(1).write.mode("overwrite").json(f"{root}/batch-{i:03d}")


def test_run_stream_matches_batch_result_and_restarts_cleanly(spark, workdir):
    src = f"{workdir}/src"
    _write_batches(spark, src, [[("c", 1, "a"), ("c", 2, "b")], [("u", 1, "A"), ("d", 2, "b")], [("c", 3, "c"), ("u", 3, "C")]])
    opts = SinkOptions(
        landing_schema=LANDING, landing_path=f"{workdir}/s_INGEST", final_path=f"{workdir}/s",
        row_schema=ROW, key_schema=KEY, timestamps=["ts"], query_name="s",
    )
    snap = CurrentTable(spark, opts.final_path, ["id"])
    snap.initialize(spark.createDataFrame([(9, "nine", None)], "id bigint, name string, ts timestamp_ntz"))

    def stream():
        return spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").json(src)

    q = run_stream(spark, stream(), opts, f"{workdir}/ckpt")
    assert len(q.block_metrics) == 3
    final = sorted((r.id, r.name) for r in snap.read().collect())
    assert final == [(1, "A"), (3, "C"), (9, "nine")]
    landing = LandingTable(spark, opts.landing_path)
    assert landing.read().count() == 5
    # restart from the checkpoint: nothing is replayed, nothing changes
    q2 = run_stream(spark, stream(), opts, f"{workdir}/ckpt")
    assert q2.block_metrics == []
    assert sorted((r.id, r.name) for r in snap.read().collect()) == final
    assert landing.read().count() == 5


def test_changelog_stream_with_gap_reload(spark, workdir):
    src = f"{workdir}/log_src"
    for i, recs in enumerate([[{"ID": 1, "Name": "a"}], [{"id": 2, "name": "b"}], [{"Id": 3, "NAME": "c"}]]):
        rows = [("t", 0, 10 * i + j, json.dumps(r)) for j, r in enumerate(recs)]
        spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string").coalesce(1).write.mode("overwrite").json(f"{src}/b{i}")
    landing = [("id", "bigint"), ("name", "string"), ("ih_topic", "string"), ("ih_partition", "int"), ("ih_offset", "string"), ("ih_op", "string")]
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in landing])
    opts = SinkOptions(landing_schema=schema, landing_path=f"{workdir}/log", mode="schemaless", reload_gap_seconds=1800, query_name="log")
    clock = iter([dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 0, 10), dt.datetime(2024, 1, 1, 0, 41)])
    stream = spark.readStream.schema("topic string, partition int, offset bigint, value string").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").json(src)
    run_changelog_stream(spark, stream, opts, f"{workdir}/log_ckpt", clock=lambda: next(clock))
    rows = ChangelogTable(spark, opts.landing_path).read().select("id", "name", "ih_offset", "ih_op").collect()
    assert [tuple(r) for r in rows] == [(3, "c", "20", "c")]


def test_maintenance_runs_once_per_interval_and_swallows_errors(spark, workdir):
    from ledgerline.streaming.runner import Maintenance

    landing = LandingTable(spark, f"{workdir}/m_INGEST")
    now = dt.datetime(2024, 1, 15, 12, 0)
    old = spark.createDataFrame([(1, now - dt.timedelta(hours=5))], "id int, ih_datetime timestamp_ntz")
    landing.land(old, "m-000000000000")
    upkeep = Maintenance(landing, "PT3M")
    assert upkeep.maybe_run(now) == {"dropped": ["m-000000000000"], "rewritten": []}
    assert upkeep.maybe_run(now + dt.timedelta(minutes=2)) is None
    failing = LandingTable(spark, f"{workdir}/m_INGEST")
    failing.expire = lambda *a, **k: (_ for _ in ()).throw(RuntimeError("storage unavailable"))
    broken = Maintenance(failing, "PT1S")
    assert broken.maybe_run(now) is None
    assert broken.maybe_run(now) is None  # not due yet
    assert (broken.runs, broken.failures) == (1, 1) and (upkeep.runs, upkeep.failures) == (1, 0)


def test_read_changes_batch_and_stream_with_trigger_limit(spark, workdir):
    from ledgerline.sources.changes import read_changes

    src = f"{workdir}/rc"
    _write_batches(spark, src, [[("c", 1, "a")], [("c", 2, "b")], [("c", 3, "c")]])
    batch = read_changes(spark, "json", src, RAW_SCHEMA, options={"recursiveFileLookup": "true"})
    assert batch.count() == 3 and batch.columns == ["topic", "partition", "offset", "key", "value"]
    seen = []
    stream = read_changes(spark, "json", src, RAW_SCHEMA, streaming=True, max_per_trigger=1,
                          options={"recursiveFileLookup": "true"})
    q = (stream.writeStream.option("checkpointLocation", f"{workdir}/rc_ckpt")
         .foreachBatch(lambda df, i: seen.append(df.count())).trigger(availableNow=True).start())
    q.awaitTermination()
    assert seen == [1, 1, 1]


def test_changelog_stream_is_compacted_between_batches(spark, workdir):
    from pyspark.sql import types as T

    src = f"{workdir}/up_src"
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ih_offset", T.StringType())])
    opts = SinkOptions(landing_schema=schema, landing_path=f"{workdir}/up", mode="schemaless", query_name="up", keys=["id"])
    for i in range(3):
        rows = [("t", 0, 10 * i + j, json.dumps({"id": j})) for j in range(2)]
        spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string").coalesce(1).write.json(f"{src}/b{i}")
        stream = spark.readStream.schema("topic string, partition int, offset bigint, value string").option("recursiveFileLookup", "true").json(src)
        run_changelog_stream(spark, stream, opts, f"{workdir}/up_ckpt", maintain_every="PT1S")
    table = ChangelogTable(spark, opts.landing_path)
    assert len(table.blocks()) == 1  # blocks whose rows are all superseded are gone
    assert sorted(r.ih_offset for r in table.read().collect()) == ["20", "21"]


def test_two_streams_of_one_name_do_not_share_blocks(spark, workdir):
    src = f"{workdir}/twin_src"
    _write_batches(spark, src, [[("c", 1, "a")]])
    opts = SinkOptions(landing_schema=LANDING, landing_path=f"{workdir}/twin_INGEST", final_path=f"{workdir}/twin", row_schema=ROW, key_schema=KEY, timestamps=["ts"])
    for k in range(2):
        stream = spark.readStream.schema(RAW_SCHEMA).option("recursiveFileLookup", "true").json(src)
        run_stream(spark, stream, opts, f"{workdir}/twin_ckpt{k}")
    assert len(LandingTable(spark, opts.landing_path).blocks()) == 2
    assert CurrentTable(spark, opts.final_path, ["id"]).read().count() == 1


def test_limited_stream_counts_the_batches_whose_commits_spark_has_removed(spark, workdir, monkeypatch):
    from ledgerline.plans import queries

    spark.range(83).selectExpr(
        "id + 5 as event_id", "timestamp_ntz'2024-01-01' as ts", "id % 7 as user_id", "elt(cast(id % 3 as int) + 1, 'view', 'error', 'click') as event_type",
        "cast(id as double) as value", "'{}' as props").write.parquet(f"{workdir}/sf/events.parquet")
    monkeypatch.setattr(queries, "LIMIT", 10)
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", "2")
    before = dict(spark.conf.getAll)
    try:
        rows = queries.stream_limited(spark, f"{workdir}/sf").collect()
    finally:
        spark.conf.unset("spark.sql.streaming.minBatchesToRetain")
    assert {k: v for k, v in before.items() if "streaming" in k} == {"spark.sql.streaming.minBatchesToRetain": "2"}
    assert not any("streaming" in k for k in spark.conf.getAll)
    assert {r.batches for r in rows} == {9}
    assert sorted((int(r.ih_offset), r.id, r.value) for r in rows) == [(k + 5, k % 7, float(k)) for k in range(83)]
