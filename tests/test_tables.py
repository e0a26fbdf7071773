"""Sinks: staging, landing, changelog, snapshots, and one flush end to end."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.plans.flush import GapReloader, SinkOptions, process_block
from ledgerline.sinks.staging import load_staged, purge_stage, stage_csv
from ledgerline.sinks.current import CurrentTable
from ledgerline.sinks.tables import ChangelogTable, LandingTable
from ledgerline.sinks import fs


def test_stage_round_trip_keeps_null_empty_and_special_text(spark, workdir):
    rows = [
        (1, 'say "hi"', None, 1.5, True, b"\x00\x01", dt.date(2050, 1, 1), dt.datetime(2018, 1, 10, 10, 30)),
        (2, "", "a,b", None, False, None, None, dt.datetime(1969, 12, 31, 23, 59, 59, 123000)),
        (3, None, "line1\nline2", 1e10, None, b"", dt.date(1969, 12, 31), None),
        (4, " back\\slash ", "\u0000x", -0.0, True, b"z", None, dt.datetime(2024, 1, 1, 0, 0, 0, 1)),
    ]
    schema = "id bigint, s string, t string, d double, b boolean, bin binary, day date, ts timestamp_ntz"
    df = spark.createDataFrame(rows, schema)
    path = f"{workdir}/stage"
    stage_csv(df, path)
    back = load_staged(spark, path, df.schema)
    assert sorted(back.collect(), key=lambda r: r["id"]) == sorted(df.collect(), key=lambda r: r["id"])
    assert purge_stage(spark, path)
    assert not fs.exists(spark, path)


def _landing_rows(spark, block, when):
    return spark.createDataFrame(
        [(1, "a", "c", when), (2, "b", "d", when)], "id bigint, v string, ih_op string, ih_datetime timestamp_ntz"
    ).withColumn("ih_blockid", F.lit(block))


def test_landing_is_idempotent_per_block_and_expires_by_folder(spark, workdir):
    t = LandingTable(spark, f"{workdir}/landing")
    now = dt.datetime(2024, 1, 15, 12, 0)
    old = _landing_rows(spark, "q-000000000001", now - dt.timedelta(hours=5))
    new = _landing_rows(spark, "q-000000000002", now - dt.timedelta(hours=1))
    t.land(old)
    t.land(old)
    t.land(new)
    assert t.read().count() == 4
    assert t.read("q-000000000001").count() == 2
    mixed = spark.createDataFrame(
        [(3, "x", "c", now - dt.timedelta(hours=6)), (4, "y", "c", None)], "id bigint, v string, ih_op string, ih_datetime timestamp_ntz"
    )
    t.land(mixed, "q-000000000003")
    result = t.expire(now)
    assert result == {"dropped": ["q-000000000001"], "rewritten": ["q-000000000003"]}
    assert sorted(r["id"] for r in t.read().collect()) == [1, 2, 4]
    assert t.blocks() == ["q-000000000002", "q-000000000003"]


def test_numeric_looking_block_ids_stay_text(spark, workdir):
    t = LandingTable(spark, f"{workdir}/numeric")
    t.land(spark.createDataFrame([(1,)], "id int"), "111")
    t.land(spark.createDataFrame([(2,)], "id int"), "0112")
    assert dict(t.read().dtypes)["ih_blockid"] == "string"
    assert [r.id for r in t.read("0112").collect()] == [2]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def block(spark, *rows):
    return spark.createDataFrame(list(rows), "id bigint, v string, ih_op string")


def test_a_repeated_batch_is_taken_back_first(spark, workdir):
    table = CurrentTable(spark, f"{workdir}/final", ["id"], partitions=3)
    table.initialize(spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string"))
    first = block(spark, (1, "A", "u"), (3, "c", "c"), (2, None, "d"))
    table.apply(first, "q1", 0)
    table.apply(block(spark, (3, "C", "u"), (4, "d", "c")), "q1", 1)
    assert rows_of(table.read()) == [(1, "A"), (3, "C"), (4, "d")]
    # the last batch again, with fewer rows: what it no longer holds is gone
    table.apply(block(spark, (4, "D", "c")), "q1", 1)
    assert rows_of(table.read()) == [(1, "A"), (3, "c"), (4, "D")]
    table.apply(block(spark, (1, None, "d")), "q1", 1)
    table.apply(block(spark, (4, "D", "c")), "q1", 1)
    assert rows_of(table.read()) == [(1, "A"), (3, "c"), (4, "D")]
    # an older batch is already in
    assert table.apply(first, "q1", 0) == []
    # a new checkpoint starts at batch 0 and only adds
    table.apply(block(spark, (5, "e", "c"), (1, None, "d")), "q2", 0)
    assert rows_of(table.read()) == [(3, "c"), (4, "D"), (5, "e")]
    # one undo per source is kept
    assert len(fs.list_dirs(spark, f"{table.path}/_undo")) == 2
    # starting over does not mix with what was there
    table.initialize(spark.createDataFrame([(9, "z")], "id bigint, v string"))
    assert rows_of(table.read()) == [(9, "z")]


def test_the_table_equals_apply_block_at_any_size(spark, workdir):
    from ledgerline.operators.apply import apply_block

    seed = spark.createDataFrame([(1, "a"), (1, "a2"), (2, "b"), (2, "b2"), (None, "n"), (3, "c")], "id bigint, v string")
    loose = block(spark, (2, "B", "u"), (2, "B2", "u"), (3, None, "d"), (None, "N", "c"), (7, None, "d"), (8, "x", "x"))
    big = spark.range(10, 60_000).selectExpr("id", "'w' as v", "if(id % 2 = 0, 'd', 'c') as ih_op")
    for name, changed in (("small", loose), ("large", loose.unionByName(big))):
        table = CurrentTable(spark, f"{workdir}/sem-{name}", ["id"])
        table.initialize(seed)
        table.apply(changed)
        assert rows_of(table.read()) == rows_of(apply_block(seed, changed, ["id"]))
        kept = {r for r in rows_of(table.read().where("id < 10 or id is null"))}
        assert kept == {(1, "a"), (1, "a2"), (2, "B"), (2, "B2"), (None, "n"), (None, "N")}
        # any session reads the folder as it is
        assert rows_of(spark.read.parquet(table.path).select("id", "v")) == rows_of(table.read())
        assert fs.list_dirs(spark, f"{table.path}/_undo") == []


def files_of(spark, path):
    return {f for d in fs.list_dirs(spark, path) if "=" in d for f in fs.list_files(spark, f"{path}/{d}")}


def test_a_block_reads_and_writes_its_own_partitions(spark, workdir):
    table = CurrentTable(spark, f"{workdir}/cost", ["id"], partitions=120)
    table.initialize(spark.range(0, 20_000).selectExpr("id", "repeat(cast(id as string), 20) as v"))
    before = files_of(spark, table.path)
    scans = []
    scan = table.scan
    table.scan = lambda schema, *folders: scans.append(scan(schema, *folders)) or scans[-1]
    touched = table.apply(spark.range(0, 60).selectExpr("id * 100 as id", "'new' as v", "'u' as ih_op"), "q", 0)
    assert 30 < len(touched) <= 60
    read = {f.rsplit("/", 2)[1] for s in scans for f in s.inputFiles()}
    assert read == set(touched)
    after = files_of(spark, table.path)
    assert {f.rsplit("/", 2)[1] for f in before ^ after} == set(touched)
    assert table.read().where("v = 'new'").count() == 60 and table.read().count() == 20_000
    # a key of one partition
    assert len(table.apply(block(spark, (100, "newer", "u")), "q", 1)) == 1


def test_emptied_partitions_go_and_come_back(spark, workdir):
    table = CurrentTable(spark, f"{workdir}/emptied", ["id"], partitions=5)
    for k in range(4):
        table.apply(block(spark, (k, f"v{k}", "c")), "q", k)
    table.apply(block(spark, *[(k, None, "d") for k in range(4)]), "q", 4)
    assert table.read().count() == 0 and files_of(spark, table.path) == set()
    table.apply(block(spark, (1, None, "d")), "q", 4)
    assert rows_of(table.read()) == [(0, "v0"), (2, "v2"), (3, "v3")]


@pytest.mark.parametrize("lost_at", ["write", "delete", "done"])
def test_a_driver_lost_while_partitions_are_replaced(spark, workdir, lost_at, monkeypatch):
    """Whatever step it dies in after the note, the next one to open the table
    finds the rows of the batch, each once."""
    from ledgerline.sinks import partitions as module

    path = f"{workdir}/lost-{lost_at}"
    table = CurrentTable(spark, path, ["id"], partitions=4)
    table.initialize(spark.createDataFrame([(k, "old") for k in range(8)], "id bigint, v string"))
    changed = block(spark, *[(k, None, "d") for k in range(6)], (6, "new", "u"), (20, "new", "c"))

    def lost(*args, **kwargs):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        if lost_at == "delete":
            m.setattr(module.fs, "delete", lost)
        else:
            m.setattr(CurrentTable, lost_at, lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            table.apply(changed, "q", 0)
    again = CurrentTable(spark, path, ["id"])
    assert rows_of(again.read()) == [(20, "new"), (6, "new"), (7, "old")]
    # the stream repeats the batch, now with other rows
    again.apply(block(spark, (7, "N", "u")), "q", 0)
    assert rows_of(again.read()) == [(0, "old"), (1, "old"), (2, "old"), (3, "old"), (4, "old"), (5, "old"), (6, "old"), (7, "N")]


def test_table_keys_match_columns_ignoring_case(spark, workdir):
    table = CurrentTable(spark, f"{workdir}/case", ["ID"])
    table.initialize(spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string"))
    table.apply(spark.createDataFrame([(2, None, "d"), (3, "c", "c")], "Id bigint, V string, ih_op string"))
    assert rows_of(table.read()) == [(1, "a"), (3, "c")]
    assert rows_of(table.lookup(spark.createDataFrame([(3,), (9,)], "Id int"), ["Id"])) == [(3, "c")]
    with pytest.raises(ValueError, match="key columns"):
        CurrentTable(spark, f"{workdir}/nokey", ["other"]).initialize(spark.range(1))


def test_retention_reads_the_day_of_the_cutoff_alone(spark, workdir):
    t = LandingTable(spark, f"{workdir}/days")
    now = dt.datetime(2024, 1, 15, 12, 0)
    for k, hours in enumerate([60, 30, 13, 5, 3, 0]):
        t.land(_landing_rows(spark, "-", now - dt.timedelta(hours=hours)).drop("ih_blockid"), f"q-{k}")
    t.land(_landing_rows(spark, "-", None).drop("ih_blockid"), "q-none")
    cutoff = now - dt.timedelta(hours=14)
    assert t.days() == ["2024-01-13", "2024-01-14", "2024-01-15"]
    edge = t.day(cutoff.date())
    assert {f.split("ih_date=")[1].split("/")[0] for f in edge.inputFiles()} == {"2024-01-14"}
    later = {f for f in t.read().inputFiles() if "2024-01-15" in f or "HIVE_DEFAULT" in f}
    assert t.expire(now, "14 hours") == {"dropped": ["q-0", "q-1"], "rewritten": []}
    assert set(t.read().inputFiles()) >= later and t.days() == ["2024-01-14", "2024-01-15"]
    # a block that was landed again on a later day has one copy
    t.land(_landing_rows(spark, "-", now).drop("ih_blockid"), "q-2")
    assert t.read("q-2").count() == 2 and not any("2024-01-14" in f for f in t.read().inputFiles())


def test_a_repeated_block_replaces_its_landing_copy_even_when_empty(spark, workdir):
    t = LandingTable(spark, f"{workdir}/repeat")
    t.land(spark.createDataFrame([(1,), (2,)], "id int"), "q-0")
    t.land(spark.createDataFrame([(3,)], "id int"), "q-1")
    t.land(spark.createDataFrame([], "id int"), "q-0")
    assert [r.id for r in t.read().collect()] == [3]
    scan = t.read("q-1").inputFiles()
    assert scan and all("ih_blockid=q-1" in f for f in scan)


def log_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "id bigint, ih_offset string")


def test_changelog_compaction_rewrites_superseded_blocks_alone(spark, workdir):
    t = ChangelogTable(spark, f"{workdir}/clog")
    for b in range(3):
        t.append(log_rows(spark, (1, str(10 + b)), (b + 2, str(b)), (None, "1"), (b + 2, None)), f"q-{b}")
    t.append(log_rows(spark, (1, "9"), (2, "7")), "q-3")
    # the newest block is left as it is, and supersedes rows of the others
    out = t.compact(["id"], keep=["q-3"])
    assert out == {"new": ["q-0", "q-1", "q-2"], "rewritten": ["q-0", "q-1"]}
    expected = [(1, "12"), (2, None), (3, "1"), (3, None), (4, "2"), (4, None), (None, "1"), (None, "1"), (None, "1")]
    assert rows_of(t.read().where("ih_blockid <> 'q-3'").select("id", "ih_offset")) == sorted(expected, key=str)
    assert rows_of(t.read("q-3").select("id", "ih_offset")) == [(1, "9"), (2, "7")]
    # a small block later: only the blocks that hold superseded rows change
    before = files_of(spark, t.path)
    t.append(log_rows(spark, (3, "50")), "q-4")
    assert t.compact(["id"], keep=["q-4"]) == {"new": ["q-3"], "rewritten": ["q-1", "q-3"]}
    changed = {f.rsplit("/", 2)[1] for f in before ^ files_of(spark, t.path)}
    assert changed == {"ih_blockid=q-1", "ih_blockid=q-3", "ih_blockid=q-4"}
    before = files_of(spark, t.path)
    assert t.compact(["id"]) == {"new": ["q-4"], "rewritten": []}
    assert t.compact(["id"]) == {"new": [], "rewritten": []}
    assert files_of(spark, t.path) == before
    kept = rows_of(t.read().where("id is not null and ih_offset is not null").select("id", "ih_offset"))
    assert kept == [(1, "12"), (2, "7"), (3, "50"), (4, "2")]


def test_compaction_block_by_block_equals_compaction_at_once(spark, workdir):
    from ledgerline.operators.maintain import compact_latest

    rows = spark.range(600).selectExpr("id % 37 as id", "cast((id * 7919) % 211 as string) as ih_offset", "id % 6 as b")
    t = ChangelogTable(spark, f"{workdir}/steps")
    for b in range(6):
        t.append(rows.where(f"b = {b}").drop("b"), f"q-{b}")
        t.compact(["id"])
    assert rows_of(t.read().select("id", "ih_offset")) == rows_of(compact_latest(rows.drop("b"), ["id"]))


def test_a_driver_lost_in_a_compaction(spark, workdir, monkeypatch):
    t = ChangelogTable(spark, f"{workdir}/lost_log")
    for b in range(3):
        t.append(log_rows(spark, (1, str(10 + b)), (b + 2, str(b))), f"q-{b}")
    for step in ("write", "_marks"):
        with monkeypatch.context() as m:
            m.setattr(ChangelogTable, step, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("driver lost")))
            with pytest.raises(RuntimeError, match="driver lost"):
                t.compact(["id"])
    ChangelogTable(spark, t.path).append(log_rows(spark, (6, "1")), "q-3")
    t.compact(["id"])
    assert rows_of(t.read().select("id", "ih_offset")) == [(1, "12"), (2, "0"), (3, "1"), (4, "2"), (6, "1")]


def test_truncation_is_whole_or_not_at_all(spark, workdir, monkeypatch):
    t = ChangelogTable(spark, f"{workdir}/whole")
    for b in range(3):
        t.append(log_rows(spark, (b, "1")), f"q-{b}")
    calls = []
    delete = fs.delete

    def lost(spark_, path):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        return delete(spark_, path)

    with monkeypatch.context() as m:
        m.setattr(fs, "delete", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            t.truncate()
    again = ChangelogTable(spark, t.path)
    again.append(log_rows(spark, (7, "1")), "q-9")
    assert again.blocks() == ["q-9"]


@pytest.mark.parametrize("lost_at", ["replace", "write", "done"])
def test_a_driver_lost_between_truncate_and_load(spark, workdir, lost_at, monkeypatch):
    """The stream repeats the block with a clock that started anew: the table
    still holds that block and no other."""
    t = ChangelogTable(spark, f"{workdir}/gap-{lost_at}")
    base = dt.datetime(2024, 1, 1)
    at = lambda m: base + dt.timedelta(minutes=m)
    g = GapReloader(spark, t, 1800, started=base)
    for b in range(3):
        g.flush(log_rows(spark, (b, "1")), f"q-{b}", at(b), True)
    with monkeypatch.context() as m:
        m.setattr(ChangelogTable, lost_at, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError, match="driver lost"):
            g.flush(log_rows(spark, (7, "1")), "q-3", at(60), True)
    fresh = ChangelogTable(spark, t.path)
    restarted = GapReloader(spark, fresh, 1800, started=at(61))
    assert restarted.flush(log_rows(spark, (7, "1")), "q-3", at(62), True) is True
    assert rows_of(fresh.read().select("id")) == [(7,)]
    assert restarted.flush(log_rows(spark, (8, "1")), "q-4", at(63), True) is False
    assert rows_of(fresh.read().select("id")) == [(7,), (8,)]


def test_gap_reloader_counts_quiet_time_and_not_outages(spark, workdir):
    t = ChangelogTable(spark, f"{workdir}/log")
    base = dt.datetime(2024, 1, 1)
    at = lambda m, s=0: base + dt.timedelta(minutes=m, seconds=s)
    rows = lambda i: spark.createDataFrame([(i,)], "id int")
    g = GapReloader(spark, t, 1800, started=base)
    assert g.flush(rows(1), "b1", at(5), True) is False
    assert g.flush(rows(2), "b2", at(35, 59), True) is False
    assert g.flush(rows(9), "b3", at(70), False) is False
    assert sorted(r["id"] for r in t.read().collect()) == [1, 2]
    # a restart after an hour of downtime starts its own clock
    assert GapReloader(spark, t, 1800, started=at(100)).flush(rows(3), "b4", at(101), True) is False
    assert t.read().count() == 3
    kept = GapReloader(spark, t, 1800, started=at(100), survive_restart=True)
    assert kept.flush(rows(4), "b5", at(131), True) is True
    assert [r["id"] for r in t.read().collect()] == [4]
    assert GapReloader(spark, t, 1800, started=at(300), survive_restart=True).flush(rows(5), "b6", at(301), True) is True


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_stage_round_trip_of_what_csv_likes_to_lose(spark, workdir, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        one = spark.createDataFrame([(None,), ("",), ("\u0001",), ("a\r\nb",), ("x,y",)], "v string").repartition(1)
        stage_csv(one, f"{workdir}/one-{zone}")
        assert rows_of(load_staged(spark, f"{workdir}/one-{zone}", one.schema)) == rows_of(one)
        times = spark.sql("select 1 as id, timestamp_seconds(1700000000.123456) as at, '\\r' as s union all select 2, null, null")
        stage_csv(times, f"{workdir}/times-{zone}")
        assert rows_of(load_staged(spark, f"{workdir}/times-{zone}", times.schema)) == rows_of(times)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_plain_records_need_a_topic(spark):
    from ledgerline.plans.flush import prepare_changelog

    raw = spark.createDataFrame([(None, 1, 41, 7)], "topic string, partition int, offset bigint, id bigint")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ih_topic", T.StringType())])
    with pytest.raises(Exception, match="topic_null"):
        prepare_changelog(raw, SinkOptions(landing_schema=schema, landing_path="unused", mode="plain")).collect()


ROW = T.StructType([T.StructField("Id", T.LongType()), T.StructField("Name", T.StringType()), T.StructField("ts", T.LongType())])
KEY = T.StructType([T.StructField("id", T.LongType())])
LANDING = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("ts", T.TimestampNTZType())]
    + [T.StructField(c, t) for c, t in [("ih_topic", T.StringType()), ("ih_offset", T.LongType()), ("ih_partition", T.IntegerType()),
                                         ("ih_op", T.StringType()), ("ih_datetime", T.TimestampNTZType()), ("ih_blockid", T.StringType())]]
)


def raw_records(spark, recs):
    rows = []
    for off, (op, i, name) in enumerate(recs):
        image = {"Id": i, "Name": name, "ts": 1515580240000}
        env = {"op": op, "before": image if op in ("u", "d") else None, "after": image if op != "d" else None}
        rows.append(("cdc.t", 0, off, json.dumps({"id": i}), json.dumps(env)))
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint, key string, value string")


def test_process_block_lands_and_applies(spark, workdir):
    opts = SinkOptions(
        landing_schema=LANDING, landing_path=f"{workdir}/t_INGEST", final_path=f"{workdir}/t",
        row_schema=ROW, key_schema=KEY, timestamps=["ts"], query_name="t",
    )
    CurrentTable(spark, opts.final_path, ["id"]).initialize(spark.createDataFrame([(1, "one", None), (5, "five", None)], "id bigint, name string, ts timestamp_ntz"))
    m = process_block(spark, raw_records(spark, [("c", 2, "two"), ("u", 1, "uno"), ("u", 2, "dos"), ("d", 5, "five")]), 0, opts)
    assert (m["records"], m["rows"], m["has_inserts"], m["has_updates"], m["has_deletes"]) == (4, 3, False, True, True)
    assert set(m["seconds"]) == {"stage", "land", "apply"}
    final = CurrentTable(spark, opts.final_path, ["id"]).read()
    assert sorted((r.id, r.name) for r in final.collect()) == [(1, "uno"), (2, "dos")]
    assert final.first()["ts"] == dt.datetime(2018, 1, 10, 10, 30, 40)
    landing = LandingTable(spark, opts.landing_path)
    assert landing.read(m["block_id"]).count() == 3
    # replaying the same batch converges: one landing copy, same final state
    process_block(spark, raw_records(spark, [("c", 2, "two"), ("u", 1, "uno"), ("u", 2, "dos"), ("d", 5, "five")]), 0, opts)
    assert landing.read().count() == 3
    assert CurrentTable(spark, opts.final_path, ["id"]).read().count() == 2


def test_staged_flush_loads_through_csv_and_purges(spark, workdir):
    opts = SinkOptions(
        landing_schema=LANDING, landing_path=f"{workdir}/g_INGEST", final_path=f"{workdir}/g", stage_path=f"{workdir}/stage",
        row_schema=ROW, key_schema=KEY, timestamps=["ts"], query_name="g",
    )
    m = process_block(spark, raw_records(spark, [("c", 1, 'quote " comma , newline \n'), ("c", 2, "")]), 0, opts)
    assert m["rows"] == 2
    final = {r.id: r.name for r in CurrentTable(spark, opts.final_path, ["id"]).read().collect()}
    assert final == {1: 'quote " comma , newline \n', 2: ""}
    assert not fs.exists(spark, f"{workdir}/stage/{m['block_id']}")
    landed = LandingTable(spark, opts.landing_path).read(m["block_id"]).collect()
    assert sorted(r.ts for r in landed) == [dt.datetime(2018, 1, 10, 10, 30, 40)] * 2


def test_strict_order_rejects_ties(spark, workdir):
    opts = SinkOptions(landing_schema=LANDING, landing_path=f"{workdir}/s_INGEST", final_path=None, row_schema=ROW,
                       key_schema=KEY, timestamps=["ts"], strict_order=True, query_name="s")
    tied = raw_records(spark, [("c", 1, "a"), ("u", 1, "b")]).withColumn("offset", F.lit(7).cast("bigint"))
    with pytest.raises(Exception, match="tied"):
        process_block(spark, tied, 0, opts)


def test_copy_only_skips_the_final_table(spark, workdir):
    opts = SinkOptions(landing_schema=LANDING, landing_path=f"{workdir}/c_INGEST", final_path=f"{workdir}/c",
                       row_schema=ROW, key_schema=KEY, timestamps=["ts"], copy_only=True, query_name="c")
    m = process_block(spark, raw_records(spark, [("c", 1, "a")]), 0, opts)
    assert m["rows"] == 1
    assert not fs.exists(spark, opts.final_path)


def test_invalid_record_stops_the_flush(spark, workdir):
    opts = SinkOptions(landing_schema=LANDING, landing_path=f"{workdir}/x_INGEST", final_path=None, row_schema=ROW, key_schema=KEY, timestamps=["ts"])
    bad = raw_records(spark, [("c", 1, "a")]).withColumn("topic", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="topic_null"):
        process_block(spark, bad, 0, opts)


def test_options_discover_landing_columns_from_the_catalog(spark, workdir):
    wider = T.StructType(list(LANDING.fields) + [T.StructField("COL2", T.StringType())])
    spark.createDataFrame([], wider).createOrReplaceTempView("events_INGEST")
    opts = SinkOptions.discover(spark, "events_INGEST", f"{workdir}/d_INGEST", ignore_columns=["COL2"], row_schema=ROW, key_schema=KEY)
    assert [f.name for f in opts.landing_schema.fields] == [f.name for f in LANDING.fields]
    assert opts.final_cols == ["id", "name", "ts"]
    assert SinkOptions(landing_schema=LANDING, landing_path="x", ignore_columns=["name"]).final_cols == ["id", "ts"]


def test_plain_records_changelog_path(spark):
    from ledgerline.plans.flush import prepare_changelog

    raw = spark.createDataFrame(
        [("t", 1, 41, 7, "seven", 1515580240000), ("t", 1, 42, 8, "eight", None)],
        "topic string, partition int, offset bigint, ID bigint, Name string, ts bigint",
    )
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("ts", T.TimestampNTZType()),
         T.StructField("ih_topic", T.StringType()), T.StructField("ih_partition", T.IntegerType()),
         T.StructField("ih_offset", T.StringType()), T.StructField("ih_op", T.StringType())]
    )
    opts = SinkOptions(landing_schema=schema, landing_path="unused", mode="plain", timestamps=["ts"])
    rows = sorted(tuple(r) for r in prepare_changelog(raw, opts).collect())
    assert rows == [
        (7, "seven", dt.datetime(2018, 1, 10, 10, 30, 40), "t", 1, "41", "c"),
        (8, "eight", None, "t", 1, "42", "c"),
    ]
