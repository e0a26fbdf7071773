"""Applying a conflated block to a current-state table.

Upsert (ops c, r, u) replaces the whole row of its key or inserts it; delete
(op d) removes its key. After conflation a key has one op, so both become one
pass: drop every key the block names (any known op), then add the block's
upsert rows. Unknown ops are landed but change nothing. Null keys never match.

Plan shape: ``final LEFT ANTI JOIN block_keys`` then ``UNION ALL`` upserts. The
block is read twice, so pass a stored one (``store_block``, or a landed block)
rather than a pending conflation: its two reads are then scans of its own rows,
and its size on disk is known to the planner, which broadcasts the keys only
when they are measured to be small. The anti join has the table on the streamed
side, so no key of the table is ever gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.constants import DELETE_OPS, IH_COLUMNS, IH_OP, KNOWN_OPS, UPSERT_OPS
from ledgerline.functions.names import norm, resolve
from ledgerline.session import work_dir


def store_block(block: DataFrame) -> DataFrame:
    """The block, evaluated once and written under the shared work folder."""
    spark = block.sparkSession
    path = f"{work_dir(spark, 'block')}/rows"
    block.write.parquet(path)
    return spark.read.schema(block.schema).parquet(path)


def _final_cols(final: DataFrame, block: DataFrame, final_cols: Sequence[str] | None) -> list[str]:
    cols = list(final_cols) if final_cols is not None else final.columns
    ih = {norm(c) for c in IH_COLUMNS}
    return [c for c in cols if norm(c) not in ih]


def _block_rows(final: DataFrame, block: DataFrame, cols: Sequence[str], ops: Sequence[str], op_col: str) -> DataFrame:
    """Block rows of ``ops``, projected and cast onto the final table's columns."""
    types = {f.name: f.dataType for f in final.schema.fields}
    out = []
    for c in cols:
        src = resolve(c, block.columns)
        value = F.col(f"`{src}`") if src is not None else F.lit(None)
        out.append(value.cast(types[c]).alias(c) if c in types else value.alias(c))
    return block.filter(F.col(op_col).isin(*ops)).select(*out)


def _block_keys(block: DataFrame, keys: Sequence[str], ops: Sequence[str], op_col: str) -> DataFrame:
    srcs = [resolve(k, block.columns) or k for k in keys]
    return block.filter(F.col(op_col).isin(*ops)).select(*[F.col(f"`{s}`").alias(k) for s, k in zip(srcs, keys)])


def merge_upsert(final: DataFrame, block: DataFrame, keys: Sequence[str], final_cols: Sequence[str] | None = None, op_col: str = IH_OP) -> DataFrame:
    """Upsert the block's c/r/u rows: replace matched keys, insert the rest."""
    return _apply(final, block, keys, final_cols, op_col, UPSERT_OPS)


def delete_by_key(final: DataFrame, block: DataFrame, keys: Sequence[str], op_col: str = IH_OP) -> DataFrame:
    """Remove the keys whose last op in the block is a delete."""
    return final.join(_block_keys(block, keys, DELETE_OPS, op_col), on=list(keys), how="left_anti")


def apply_block(final: DataFrame, block: DataFrame, keys: Sequence[str], final_cols: Sequence[str] | None = None, op_col: str = IH_OP) -> DataFrame:
    """New current state = rows of keys the block does not touch + its upserts."""
    return _apply(final, block, keys, final_cols, op_col, KNOWN_OPS)


def _apply(final: DataFrame, block: DataFrame, keys: Sequence[str], final_cols: Sequence[str] | None, op_col: str, ops: Sequence[str]) -> DataFrame:
    cols = _final_cols(final, block, final_cols)
    upserts = _block_rows(final, block, cols, UPSERT_OPS, op_col)
    kept = final.select(*cols).join(_block_keys(block, keys, ops, op_col), on=list(keys), how="left_anti")
    return kept.unionByName(upserts)


def merge_into_table(block: DataFrame, table: str, keys: Sequence[str], final_cols: Sequence[str], op_col: str = IH_OP) -> None:
    """Row-level MERGE into a catalog table that supports it (DSv2 formats).

    Deletes, upserts and inserts in one statement: the intended path on a
    cluster. No such format is installed where this library is tested, so it
    has only been seen to be well-formed. Plain Parquet tables reject MERGE; use ``sinks.current.CurrentTable`` for those.
    """
    target = table.split(".")[-1]
    cond = " AND ".join(f"{target}.`{k}` = s.`{k}`" for k in keys)
    assignments = {f"`{c}`": F.col(f"s.`{c}`") for c in final_cols}
    src = block.filter(F.col(op_col).isin(*KNOWN_OPS)).alias("s")
    is_delete = F.col(f"s.`{op_col}`").isin(*DELETE_OPS)
    (
        src.mergeInto(table, F.expr(cond))
        .whenMatched(is_delete)
        .delete()
        .whenMatched()
        .update(assignments)
        .whenNotMatched(~is_delete)
        .insert(assignments)
        .merge()
    )
