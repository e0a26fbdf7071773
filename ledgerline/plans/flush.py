"""One flush (micro-batch) of change records, end to end.

Typed CDC records::

    decode -> fail on invalid -> route image -> provenance -> conflate by key
    -> align to the landing columns -> land the block (idempotent)
    -> apply the landed block to the current-state table (unless copy_only)

With ``stage_path`` the block is staged as gzip CSV, loaded from there into
the landing table and the stage purged (kept in copy-only mode).

Changelog records (schemaless or plain)::

    decode -> fail on invalid -> provenance (offset as text) -> align
    -> gap check (truncate after a quiet spell) -> append

Every write is keyed by the streaming query's persistent id and the batch id,
so a replayed batch converges to the same tables and no other batch touches
them. Record counts before and after conflation and the block's flags come
from ``Observation``s on the landing write: no extra pass, and an empty or
op-less block skips the apply.

The last change of a key is the one with the greatest record time, then
partition, then offset (``ORDER``): offsets only order one partition, and
restart with a new topic, while the record time also orders a key that moved.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
import logging
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.constants import IH_BLOCKID, IH_COLUMNS, IH_OFFSET, IH_PARTITION, LANDING_RETENTION, RELOAD_GAP_SECONDS
from ledgerline.functions.ids import block_id as make_block_id
from ledgerline.operators.align import align_to_target
from ledgerline.operators.conflate import conflate_latest, observed_block, observed_rows
from ledgerline.operators.provenance import add_provenance
from ledgerline.operators.route import IH_KEY, RECORD_TIME, plain_records, route_image
from ledgerline.operators.validate import fail_on_invalid, fail_on_invalid_plain, fail_on_invalid_schemaless
from ledgerline.sinks import fs
from ledgerline.sinks.staging import copy_into_landing, stage_csv
from ledgerline.sinks.current import PARTITIONS, CurrentTable
from ledgerline.sinks.tables import ChangelogTable, LandingTable
from ledgerline.sources.catalog import final_columns, require_columns, target_columns, target_schema
from ledgerline.sources.decode import decode_envelope, decode_schemaless, primary_key

log = logging.getLogger(__name__)

ORDER = (RECORD_TIME, IH_PARTITION, IH_OFFSET)


@dataclasses.dataclass
class SinkOptions:
    """What a flush needs to know about its targets."""

    landing_schema: T.StructType
    landing_path: str
    final_path: str | None = None
    row_schema: T.StructType | None = None
    key_schema: T.StructType | None = None
    keys: Sequence[str] | None = None
    order_by: Sequence[str] = ORDER  # columns the records lack are left out
    strict_order: bool = False  # fail the batch if the last change of a key is tied or unordered
    timestamps: Sequence[str] = ()
    dates: Sequence[str] = ()
    times: Sequence[str] = ()
    zone: str = "UTC"
    date_mode: str = "true"
    copy_only: bool = False
    query_name: str = "ledgerline"
    mode: str = "cdc"  # cdc (typed) | cdc_schemaless | schemaless (plain map) | plain (typed columns)
    exclude: Sequence[str] = IH_COLUMNS
    retention: str = LANDING_RETENTION
    reload_gap_seconds: int | None = None
    reload_after_outage: bool = False  # count downtime as a quiet gap
    keep: Sequence[str] = ()
    partitions: int = PARTITIONS  # hash partitions of the current-state table, when it is made
    stage_path: str | None = None  # stage each block as gzip CSV and load it from there

    ignore_columns: Sequence[str] = ()

    def __post_init__(self):
        if self.ignore_columns:
            kept = set(target_columns(None, self.landing_schema, ignore=self.ignore_columns))
            self.landing_schema = T.StructType([f for f in self.landing_schema.fields if f.name in kept])

    @property
    def final_cols(self) -> list[str]:
        return final_columns([f.name for f in self.landing_schema.fields], self.exclude)

    @classmethod
    def discover(
        cls,
        spark: SparkSession,
        landing_table: str,
        landing_path: str,
        ignore_columns: Sequence[str] = (),
        distinct: bool = False,
        **options,
    ) -> "SinkOptions":
        """Options whose landing columns come from a catalog table, read once.

        The ordered column list is the landing table's, minus ``ignore_columns``
        (exact case), optionally de-duplicated; an empty list is an error.
        """
        schema = target_schema(spark, landing_table)
        names = target_columns(spark, schema, ignore=ignore_columns, distinct=distinct)
        by_name = {f.name: f for f in schema.fields}
        return cls(landing_schema=T.StructType([by_name[n] for n in names]), landing_path=landing_path, **options)


def prepare_block(raw: DataFrame, opts: SinkOptions, block: str, now=None, observe=None) -> DataFrame:
    """Decode, validate, route, stamp and conflate; aligned to the landing
    columns. ``observe`` sees the records before conflation."""
    if opts.mode != "cdc":
        raise ValueError("prepare_block handles typed CDC records; use prepare_changelog for the others")
    decoded = decode_envelope(raw, opts.row_schema, opts.key_schema)
    checked = fail_on_invalid(decoded)
    routed = add_provenance(route_image(checked, keep=opts.keep), block_id=block, now=now)
    if observe is not None:
        routed = observe(routed)
    keys = [IH_KEY] if IH_KEY in routed.columns else list(opts.keys or [])
    order = [c for c in opts.order_by if c in routed.columns]
    conflated = conflate_latest(routed, keys, order_by=order, strict=opts.strict_order)
    return align_to_target(
        conflated,
        opts.landing_schema,
        timestamps=opts.timestamps,
        dates=opts.dates,
        times=opts.times,
        zone=opts.zone,
        date_mode=opts.date_mode,
    )


def process_block(spark: SparkSession, raw: DataFrame, batch_id: int, opts: SinkOptions, now=None, source: str | None = None) -> dict:
    """Run one typed-CDC flush; returns the block's metrics: ``records`` read,
    ``rows`` left by conflation, the op flags and ``seconds`` by step.

    ``source`` is the streaming query's persistent id (None: batches of one
    caller, told apart by ``batch_id`` alone).
    """
    block = make_block_id(opts.query_name, batch_id, source)
    require_columns([f.name for f in opts.landing_schema.fields], opts.final_cols)
    records: list = []

    def observe(df: DataFrame) -> DataFrame:
        df, seen = observed_rows(df, f"records_{block}")
        records.append(seen)
        return df

    began = time.perf_counter()
    observed, obs = observed_block(prepare_block(raw, opts, block, now, observe), f"block_{block}")
    landing = LandingTable(spark, opts.landing_path)
    if opts.stage_path is None:
        landing.land(observed, block)
        staged = time.perf_counter()
    else:
        stage = f"{opts.stage_path.rstrip('/')}/{block}"
        stage_csv(observed, stage, [f.name for f in opts.landing_schema.fields])
        staged = time.perf_counter()
        copy_into_landing(spark, stage, landing, opts.landing_schema, purge=not opts.copy_only, block_id=block)
    landed = time.perf_counter()
    metrics = dict(obs.get) | {"records": records[0].get["rows"], "block_id": block}
    seconds = {"stage": staged - began, "land": landed - staged}
    changes = metrics["has_inserts"] or metrics["has_updates"] or metrics["has_deletes"]
    if changes and not opts.copy_only and opts.final_path is not None:
        table = CurrentTable(spark, opts.final_path, _keys(raw, opts), opts.partitions)
        rows = landing.read(block, schema=_landing_read_schema(opts.landing_schema))
        table.apply(rows, source or opts.query_name, batch_id, final_cols=opts.final_cols)
        seconds["apply"] = time.perf_counter() - landed
    log.info("block %s: %s records, %s rows", block, metrics["records"], metrics["rows"])
    return metrics | {"seconds": seconds}


def _landing_read_schema(schema: T.StructType) -> T.StructType:
    """The landing schema as stored: ``ih_blockid`` is the (text) partition column, last."""
    fields = [f for f in schema.fields if f.name != IH_BLOCKID]
    return T.StructType(fields + [T.StructField(IH_BLOCKID, T.StringType(), True)])


def _keys(raw: DataFrame, opts: SinkOptions) -> list[str]:
    if opts.keys:
        return list(opts.keys)
    if opts.key_schema is not None:
        return [f.name for f in opts.key_schema.fields]
    return primary_key(raw.schema)


def prepare_changelog(raw: DataFrame, opts: SinkOptions) -> DataFrame:
    """Changelog rows (no conflation): every event, offset as text."""
    if opts.mode == "plain":
        checked = fail_on_invalid_plain(raw)
        rows = plain_records(checked.drop("key") if "key" in checked.columns else checked)
        return align_to_target(add_provenance(rows, variant="changelog"), opts.landing_schema,
                               timestamps=opts.timestamps, dates=opts.dates, times=opts.times,
                               zone=opts.zone, date_mode=opts.date_mode)
    if opts.mode not in ("cdc_schemaless", "schemaless"):
        raise ValueError(f"unknown changelog mode {opts.mode!r}")
    cdc = opts.mode == "cdc_schemaless"
    decoded = fail_on_invalid_schemaless(decode_schemaless(raw, cdc=cdc), cdc)
    if not cdc:
        decoded = decoded.withColumn("op", F.lit("c"))
    meta = {"topic": "ih_topic", "partition": "ih_partition", "offset": "ih_offset", "op": "ih_op"}
    # a payload field may be named like any other record column (``timestamp``),
    # so nothing but the record's position goes along with the payload
    renamed = decoded.select(*[F.col(c).alias(meta[c]) for c in meta if c in decoded.columns], "fields")
    stamped = add_provenance(renamed, variant="changelog")
    return align_to_target(stamped, opts.landing_schema, timestamps=opts.timestamps, dates=opts.dates,
                           times=opts.times, zone=opts.zone, date_mode=opts.date_mode, map_col="fields")


class GapReloader:
    """Changelog appends that empty the table after a quiet gap.

    The clock starts with the reloader (``started``), so an outage is not a
    quiet gap. With ``survive_restart`` the last non-empty flush is also kept
    in a marker file next to the table and an outage counts. An empty flush
    does not move the clock.

    That a block reloads the table is noted before anything is done, and
    emptying and loading are one step of the table (``ChangelogTable.reload``):
    a block that is flushed again, after a driver was lost anywhere on the way,
    reloads again whatever the new clock says, and ends with the same rows.
    """

    def __init__(
        self, spark: SparkSession, table: ChangelogTable, gap_seconds: int = RELOAD_GAP_SECONDS, started: _dt.datetime | None = None, survive_restart: bool = False
    ):
        self.spark = spark
        self.table = table
        self.gap_minutes = gap_seconds // 60
        self.survive_restart = survive_restart
        self.marker = f"{table.path}_last_flush"
        text = fs.read_text(spark, self.marker) if survive_restart else None
        self.last = _dt.datetime.fromisoformat(text.strip()) if text else started

    def should_reload(self, now: _dt.datetime) -> bool:
        if self.last is None:
            return False
        whole = int((now - self.last).total_seconds() // 60)
        return whole > self.gap_minutes

    def flush(self, rows: DataFrame, block: str, now: _dt.datetime, nonempty: bool) -> bool:
        if not nonempty:
            return False
        note = f"{self.table.path}/_reload.txt"
        reloaded = self.should_reload(now) or fs.read_text(self.spark, note) == block
        if reloaded:
            fs.write_text(self.spark, note, block)
            self.table.reload(rows, block)
        else:
            self.table.append(rows, block)
        self.last = now
        if self.survive_restart:
            fs.write_text(self.spark, self.marker, now.isoformat())
        return reloaded


__all__ = ["GapReloader", "SinkOptions", "prepare_block", "prepare_changelog", "process_block"]
