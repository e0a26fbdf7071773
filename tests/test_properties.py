"""Properties (Hypothesis): block splits, idempotence, CSV round trip."""

import string

from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.operators.apply import apply_block
from ledgerline.operators.conflate import conflate_latest
from ledgerline.operators.maintain import compact_latest
from ledgerline.sinks.staging import load_staged, stage_csv

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

changes = st.lists(st.tuples(st.integers(0, 6), st.sampled_from("crud"), st.integers(0, 99)), min_size=1, max_size=25)
seed_keys = st.sets(st.integers(0, 6), max_size=6)


def _frames(spark, chg, seed):
    rows = [(k, op, v, off) for off, (k, op, v) in enumerate(chg)]
    ch = spark.createDataFrame(rows, "id int, ih_op string, v int, ih_offset bigint")
    final = spark.createDataFrame([(k, -1) for k in sorted(seed)], "id int, v int")
    return ch, final


def _state(df):
    return sorted(tuple(r) for r in df.collect())


@SETTINGS
@given(chg=changes, seed=seed_keys, cut=st.integers(0, 25))
def test_any_split_into_two_blocks_equals_one_block(spark, chg, seed, cut):
    ch, final = _frames(spark, chg, seed)
    once = apply_block(final, conflate_latest(ch, ["id"]), ["id"])
    first, second = ch.where(f"ih_offset < {cut}"), ch.where(f"ih_offset >= {cut}")
    twice = apply_block(apply_block(final, conflate_latest(first, ["id"]), ["id"]), conflate_latest(second, ["id"]), ["id"])
    assert _state(once) == _state(twice)


@SETTINGS
@given(chg=changes, seed=seed_keys)
def test_applying_a_block_twice_equals_once(spark, chg, seed):
    ch, final = _frames(spark, chg, seed)
    block = conflate_latest(ch, ["id"])
    once = apply_block(final, block, ["id"])
    assert _state(apply_block(once, block, ["id"])) == _state(once)


@SETTINGS
@given(chg=changes)
def test_compaction_is_idempotent(spark, chg):
    ch, _ = _frames(spark, chg, set())
    once = compact_latest(ch, ["id"])
    assert _state(compact_latest(once, ["id"])) == _state(once)
    assert {r[0] for r in once.collect()} == {r[0] for r in ch.collect()}


text = st.one_of(st.none(), st.text(alphabet=string.ascii_letters + ' ",\n\r\\\'\t;', max_size=8))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.tuples(text, text), min_size=1, max_size=8))
def test_csv_round_trip_preserves_text(spark, workdir, values):
    rows = [(i, a, b) for i, (a, b) in enumerate(values)]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    path = f"{workdir}/rt-{abs(hash(tuple(values)))}"
    stage_csv(df.coalesce(1), path)
    assert sorted(load_staged(spark, path, df.schema).collect()) == sorted(df.collect())


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(chg=changes, seed=seed_keys, cut=st.integers(0, 25), again=st.booleans())
def test_a_table_of_two_blocks_equals_one_block(spark, workdir, chg, seed, cut, again):
    from ledgerline.sinks.current import CurrentTable

    ch, final = _frames(spark, chg, seed)
    expected = _state(apply_block(final, conflate_latest(ch, ["id"]), ["id"]))
    table = CurrentTable(spark, f"{workdir}/prop-{abs(hash((tuple(chg), tuple(sorted(seed)), cut, again)))}", ["id"], partitions=3)
    table.initialize(final)
    table.apply(conflate_latest(ch.where(f"ih_offset < {cut}"), ["id"]), "q", 0)
    if again:  # the second batch first with all changes the wrong way round
        table.apply(conflate_latest(ch.withColumn("ih_offset", -F.col("ih_offset")), ["id"]), "q", 1)
    table.apply(conflate_latest(ch.where(f"ih_offset >= {cut}"), ["id"]), "q", 1)
    assert _state(table.read()) == expected
