"""ledgerline: change-data-capture streams to tables, on Spark.

The pieces compose as DataFrame -> DataFrame functions::

    changes = decode_envelope(raw, row_schema, key_schema)   # sources
    changes = route_image(changes)                           # operators
    block = conflate_latest(changes, pks)                    # operators
    block = align_to_target(block, landing_schema)           # operators
    final = apply_block(final, block, pks)                   # operators

and `plans.flush.process_block` / `streaming.runner.run_stream` wire them
to tables and to Structured Streaming.
"""

from ledgerline.constants import DELETE_OPS, IH_COLUMNS, KNOWN_OPS, UPSERT_OPS
from ledgerline.operators.align import align_to_target
from ledgerline.operators.apply import apply_block, delete_by_key, merge_into_table, merge_upsert
from ledgerline.operators.conflate import block_flags, block_metrics, conflate_latest
from ledgerline.operators.maintain import compact_latest, expire_landing, reload_on_gap
from ledgerline.operators.provenance import add_provenance
from ledgerline.operators.route import plain_records, route_image
from ledgerline.operators.validate import fail_on_invalid, validate_changes
from ledgerline.plans.flush import SinkOptions, process_block
from ledgerline.session import get_session, work_dir
from ledgerline.sinks.staging import load_staged, stage_csv
from ledgerline.sinks.current import CurrentTable
from ledgerline.sinks.tables import ChangelogTable, LandingTable
from ledgerline.sources.catalog import final_columns, target_columns
from ledgerline.sources.changes import read_changes
from ledgerline.sources.decode import decode_envelope, decode_schemaless
from ledgerline.streaming.runner import run_changelog_stream, run_stream

__all__ = [
    "DELETE_OPS", "IH_COLUMNS", "KNOWN_OPS", "UPSERT_OPS",
    "ChangelogTable", "CurrentTable", "LandingTable", "SinkOptions",
    "add_provenance", "align_to_target", "apply_block", "block_flags", "block_metrics",
    "compact_latest", "conflate_latest", "decode_envelope", "decode_schemaless", "delete_by_key",
    "expire_landing", "fail_on_invalid", "final_columns", "get_session", "load_staged",
    "merge_into_table", "merge_upsert", "plain_records", "process_block", "read_changes",
    "reload_on_gap", "route_image", "run_changelog_stream", "run_stream", "stage_csv",
    "target_columns", "validate_changes", "work_dir",
]
