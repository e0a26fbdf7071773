"""Catalog tables, per-batch reports, lookups in wide schemaless records."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import align
from ledgerline.sinks.catalog_table import CatalogTable
from ledgerline.sinks.staging import stage_csv


@pytest.fixture()
def database(spark, workdir):
    name = f"ll_test_{workdir.rsplit('-', 1)[1]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{workdir}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_load_by_column_list_truncate_and_drop(spark, workdir, database):
    schema = T._parse_datatype_string("v string, id bigint, day string, hour int")
    table = CatalogTable(spark, f"{database}.t")
    table.create(schema, ["day", "hour"])
    table.create(schema, ["day", "hour"])  # there already
    rows = spark.createDataFrame([(1, "a'b", 1, "x"), (2, "2024-01-02", 2, None)], "id bigint, day string, hour int, v string")
    table.load(rows)
    assert rows_of(table.read()) == [("x", 1, "a'b", 1), (None, 2, "2024-01-02", 2)]
    # named otherwise than the frame's columns, and fewer of them
    table.load(spark.createDataFrame([("2024-01-02", 9, 3)], "p string, q bigint, r int"), ["day", "id", "hour"])
    assert rows_of(table.read().where("id = 9")) == [(None, 9, "2024-01-02", 3)]
    stage_csv(spark.createDataFrame([(7, "2024-01-03", 0)], "id bigint, day string, hour int"), f"{workdir}/stage")
    table.copy_into(f"{workdir}/stage", T._parse_datatype_string("id bigint, day string, hour int"))
    assert table.read().count() == 4
    table.drop_partition(day="a'b")
    table.drop_partition(day="2024-01-02", hour=2)
    table.drop_partition(day="never")
    assert sorted(r.id for r in table.read().collect()) == [7, 9]
    scan = table.read().where("day = '2024-01-03'")
    assert len(scan.inputFiles()) >= 1 and "PartitionFilters: [isnotnull(day" in scan._jdf.queryExecution().executedPlan().toString()
    table.truncate()
    assert table.read().count() == 0 and table.read().columns == ["v", "id", "day", "hour"]


FIELDS = [json.dumps({"A": "1", "b": None, "a": "2"}), json.dumps({"B": "x\u0001\"\\\n{}", "Ab": "é", "missing ": "no"}), json.dumps({}), None, "not json", json.dumps({"b": {"x": [1, 2]}})]


def test_wide_lookup_equals_lookup_by_name(spark, monkeypatch):
    from ledgerline.sources.decode import decode_schemaless

    raw = spark.createDataFrame([(k, v) for k, v in enumerate(FIELDS)], "k int, value string")
    target = ["k_out", "a", "b", "AB", "missing", "ih_offset"]
    decoded = decode_schemaless(raw, cdc=False).withColumn("ih_offset", F.col("k").cast("string"))
    results = []
    for wide in (0, 100):
        monkeypatch.setattr(align, "WIDE", wide)
        results.append(rows_of(align.align_to_target(decoded, [(c, "string") for c in target], map_col="fields")))
    assert results[0] == results[1]
    assert (None, "2", None, None, None, "0") in results[0]


def test_a_wide_record_is_gone_through_once(spark):
    names = [f"f{k}" for k in range(300)]
    df = spark.createDataFrame([({n.upper(): n for n in names},)], "fields map<string,string>")
    out = align.align_to_target(df, [(n, "string") for n in names], map_col="fields")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and "filter(" not in plan
    assert list(out.first()) == names


def test_a_wide_record_is_written_once_for_all_its_fields(spark):
    names = [f"f{k}" for k in range(300)]
    df = spark.createDataFrame([({n.upper(): n for n in names},)], "fields map<string,string>")
    spark.conf.set("spark.sql.debug.maxToStringFields", "2000")
    try:
        plan = align.align_to_target(df, [(n, "string") for n in names], map_col="fields")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert "StructsToJsonEvaluator" in plan and "map_entries(" not in plan


def test_wide_lookup_of_odd_keys_and_values(spark, monkeypatch):
    from ledgerline.sources.decode import decode_schemaless

    odd = {"\u00c9\u03a3": "\u03a3\u00c9 Q", "\u00c9\u03c2": "L\u0130", 'K"\\\u001fY': 'V"},{"K\\\u001f', "A'\u03a3B": "", "NULL": None, "\U0001f600X": "\U0001f600X", "N": {"Aa": ["B\n", None]}, "B ": "Z"}
    raw = spark.createDataFrame([(k, json.dumps(v, ensure_ascii=e)) for k, (v, e) in enumerate([(odd, True), (odd, False), ({}, True)])] + [(3, '{"A":"X","a":null}'), (4, '{"a":null,"A":"X","A":"Y"}')], "k int, value string")
    decoded = decode_schemaless(raw, cdc=False).withColumn("ih_offset", F.col("k").cast("string"))
    target = [*odd, "a", "ih_offset"]
    target.remove("\u00c9\u03c2")  # the same name in lower case
    results = []
    for wide in (0, 100):
        monkeypatch.setattr(align, "WIDE", wide)
        results.append(rows_of(align.align_to_target(decoded, [(c, "string") for c in target], map_col="fields")))
    assert results[0] == results[1] and any("L\u0130" in r for r in results[0])


def test_progress_is_kept_per_batch(spark, workdir):
    import time

    from ledgerline.streaming.progress import FlushProgress, counted
    from ledgerline.streaming.runner import append_stream

    name = f"progress_{workdir.rsplit('-', 1)[1]}"
    listener, other = FlushProgress(name), FlushProgress("another query")
    spark.streams.addListener(listener)
    spark.streams.addListener(other)
    try:
        for b, ops in enumerate(["cud", "dd", "x"]):
            spark.createDataFrame([(o,) for o in ops], "ih_op string").write.parquet(f"{workdir}/src/b{b}")
            stream = spark.readStream.schema("ih_op string").option("recursiveFileLookup", "true").parquet(f"{workdir}/src")
            append_stream(counted(stream), f"{workdir}/out", f"{workdir}/ckpt", name).awaitTermination()
        until = time.monotonic() + 60
        while len(listener.batches) < 3 and time.monotonic() < until:
            time.sleep(0.05)
    finally:
        spark.streams.removeListener(listener)
        spark.streams.removeListener(other)
    seen = [tuple(listener.batches[b][k] for k in ("records", "rows", "upserts", "deletes", "failures")) for b in range(3)]
    assert seen == [(3, 3, 2, 1, 0), (2, 2, 0, 2, 0), (1, 1, 0, 0, 0)] and other.batches == {}
    assert spark.read.parquet(f"{workdir}/out").count() == 6


def test_default_time_is_utc_now(spark):
    from ledgerline.operators.provenance import add_provenance

    rows = spark.createDataFrame([("t", 0, 1, "c")], "ih_topic string, ih_partition int, ih_offset bigint, ih_op string")
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    stamp = add_provenance(rows, block_id="b").first()["ih_datetime"]
    assert before - dt.timedelta(milliseconds=1) <= stamp <= dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
