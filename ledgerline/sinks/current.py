"""The current-state table: plain Parquet in hash partitions of the key.

A row stands in the partition ``ll_part = pmod(xxhash64(key), partitions)``, so the
keys of a block say which partitions it can change. Applying a block reads
those alone (a literal partition filter), joins them to the block's keys once,
and overwrites them by dynamic partition overwrite; the rest of the table is
neither listed nor read nor written. Any Spark session reads the table as the
Parquet folder it is.

The one join also sets aside the rows that the block replaces or removes. A
micro-batch that is repeated with other rows (``source`` and ``batch_id`` name the
batch) is first taken back with them; one older than the last of its source is
already in and changes nothing. Where the key has a null part, rows are never
matched, as in a MERGE: they are spread over all partitions, and a batch that
is repeated adds its own again.

``merge_into_table`` (``operators.apply``) is the path on a table format with
row-level MERGE. The number of partitions is chosen once, when the table is
made: a partition should hold some hundreds of MB.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.constants import DELETE_OPS, IH_COLUMNS, IH_OP, KNOWN_OPS, UPSERT_OPS
from ledgerline.functions.names import resolve
from ledgerline.sinks import fs
from ledgerline.sinks.partitions import PartitionedFolder

PARTITIONS = 8
_PART, _OP, _NAMED, _KEPT = "ll_part", "ll_op", "ll_named", "ll_kept"


class CurrentTable(PartitionedFolder):
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], partitions: int = PARTITIONS):
        super().__init__(spark, path, [T.StructField(_PART, T.IntegerType())])
        self.keys = list(keys)
        self.partitions = partitions

    # -- what the table is -------------------------------------------------------

    def _table(self) -> dict | None:
        text = fs.read_text(self.spark, f"{self.path}/_table.json")
        return json.loads(text) if text else None

    def exists(self) -> bool:
        return self._table() is not None

    def _made(self, schema: T.StructType) -> dict:
        names = [resolve(k, schema.names) for k in self.keys]
        if None in names:
            missing = [k for k, n in zip(self.keys, names) if n is None]
            raise ValueError(f"key columns {missing} are not columns of {self.path}")
        return {"schema": schema.json(), "keys": names, "partitions": self.partitions}

    def _part(self, table: dict, columns: Sequence[str]) -> Column:
        """The partition of a row; one without a whole key goes anywhere."""
        keys = [F.col(f"`{k}`") for k in table["keys"]]
        whole = F.lit(True)
        for k in keys:
            whole = whole & k.isNotNull()
        spread = F.when(whole, F.xxhash64(*keys)).otherwise(F.xxhash64(*[F.col(f"`{c}`") for c in columns]))
        return F.pmod(spread, F.lit(table["partitions"])).cast("int")

    def read(self) -> DataFrame:
        self.recover()
        table = self._table()
        if table is None:
            raise ValueError(f"no table under {self.path}")
        schema = T.StructType.fromJson(json.loads(table["schema"]))
        return self.scan(schema).select(*[F.col(f"`{c}`") for c in schema.names])

    def initialize(self, df: DataFrame) -> None:
        """Start over from a seed, with nothing applied."""
        self.recover()
        made = self._made(df.schema)
        rows = df.withColumn(_PART, self._part(made, df.columns)).hint("rebalance", _PART)
        old = [d for d in fs.list_dirs(self.spark, self.path) if d.startswith(f"{_PART}=")] if fs.exists(self.spark, self.path) else []
        every = {f"{_PART}={k}" for k in range(made["partitions"])}
        self.replace(rows, sorted(every | set(old)), table=made, forget=True)

    def lookup(self, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Rows of the keys in ``wanted``; only their partitions are read."""
        self.recover()
        table = self._table()
        schema = T.StructType.fromJson(json.loads(table["schema"]))
        kinds = {f.name: f.dataType for f in schema.fields}
        own = wanted.select(*[F.col(f"`{k}`").cast(kinds[n]).alias(n) for k, n in zip(keys, table["keys"])]).distinct()
        parts = [f"{_PART}={r[0]}" for r in own.select(self._part(table, own.columns).alias("p")).distinct().collect()]
        there = [p for p in parts if fs.exists(self.spark, f"{self.path}/{p}")]
        rows = self.scan(schema, *there) if there else self.spark.createDataFrame([], schema)
        return rows.join(own, table["keys"], "left_semi").select(*[F.col(f"`{c}`") for c in schema.names])

    # -- applying blocks -----------------------------------------------------------

    def _batch_path(self, source: str) -> str:
        return f"{self.path}/_batches/{source}.json"

    def _batch(self, source: str | None) -> dict | None:
        text = fs.read_text(self.spark, self._batch_path(source)) if source is not None else None
        return json.loads(text) if text else None

    def apply(
        self, block: DataFrame, source: str | None = None, batch_id: int | None = None, final_cols: Sequence[str] | None = None, op_col: str = IH_OP
    ) -> list[str]:
        """Apply a block of changes (evaluated once); returns the partitions
        that were read and written."""
        self.recover()
        table = self._table()
        if table is None:
            cols = list(final_cols) if final_cols is not None else [c for c in block.columns if c not in IH_COLUMNS]
            table = self._made(block.select(*[F.col(f"`{c}`") for c in cols]).schema)
            fs.write_text(self.spark, f"{self.path}/_table.json", json.dumps(table))
        last = self._batch(source)
        if last is not None:
            if batch_id < last["batch"] or (batch_id == last["batch"] and last["undo"] is None):
                return []
            if batch_id == last["batch"]:
                self._take_back(table, source, last)
        schema = T.StructType.fromJson(json.loads(table["schema"]))
        wanted = {c.lower() for c in final_cols} if final_cols is not None else None
        row = []
        for field in schema.fields:
            name = resolve(field.name, block.columns) if wanted is None or field.name.lower() in wanted else None
            value = F.col(f"`{name}`") if name is not None else F.lit(None)
            row.append(value.cast(field.dataType).alias(field.name))
        changed = block.where(F.col(op_col).isin(*KNOWN_OPS)).select(*row, F.col(op_col).alias(_OP))
        return self._apply(table, schema, changed, source, batch_id)

    def _apply(self, table: dict, schema: T.StructType, changed: DataFrame, source: str | None, batch_id: int | None, undoable: bool = True) -> list[str]:
        name = f"_undo/{uuid.uuid4().hex}"
        placed = changed.withColumn(_PART, self._part(table, schema.names))
        placed.write.parquet(f"{self.path}/{name}/changed")
        changed = self.spark.read.schema(placed.schema).parquet(f"{self.path}/{name}/changed")
        # at most one row per partition of the table
        touched = [f"{_PART}={r[0]}" for r in changed.select(_PART).distinct().orderBy(_PART).collect()]
        there = [t for t in touched if fs.exists(self.spark, f"{self.path}/{t}")]
        columns = [F.col(f"`{c}`") for c in schema.names] + [F.col(_PART)]
        rows = changed.where(F.col(_OP).isin(*UPSERT_OPS)).select(*columns, F.lit(True).alias(_KEPT))
        if there:
            named = changed.select(*[F.col(f"`{k}`") for k in table["keys"]], F.lit(True).alias(_NAMED)).distinct()
            met = self.scan(schema, *there).join(named, on=table["keys"], how="left")
            rows = rows.unionByName(met.select(*columns, F.col(_NAMED).isNull().alias(_KEPT)))
        # one pass writes the partitions as they will be and, beside them, the rows that go
        rows.hint("rebalance", _KEPT, _PART).write.partitionBy(_KEPT, _PART).parquet(f"{self.path}/{name}/rows")
        self.put(f"{name}/rows/{_KEPT}=true", T.StructType(schema.fields + self.columns), touched, undo=name, source=source, batch=batch_id, undoable=undoable)
        return touched

    def _take_back(self, table: dict, source: str, last: dict) -> None:
        """The table as it was before the last batch of ``source``."""
        schema = T.StructType.fromJson(json.loads(table["schema"]))
        undo = f"{self.path}/{last['undo']}"
        changed = self.spark.read.parquet(f"{undo}/changed")
        columns = [F.col(f"`{c}`") for c in schema.names]
        gone = self.spark.createDataFrame([], schema)
        if fs.exists(self.spark, f"{undo}/rows/{_KEPT}=false"):
            gone = self.spark.read.schema(schema).parquet(f"{undo}/rows/{_KEPT}=false").select(*columns)
        added = changed.join(gone, on=table["keys"], how="left_anti")
        restore = gone.withColumn(_OP, F.lit(UPSERT_OPS[-1])).unionByName(added.select(*columns, F.lit(DELETE_OPS[0]).alias(_OP)))
        self._apply(table, schema, restore, source, last["batch"] - 1, undoable=False)

    def done(self, note: dict) -> None:
        if note.get("table"):
            fs.write_text(self.spark, f"{self.path}/_table.json", json.dumps(note["table"]))
        if note.get("forget"):
            fs.delete(self.spark, f"{self.path}/_batches")
            fs.delete(self.spark, f"{self.path}/_undo")
            return
        source, undo = note["source"], note["undo"]
        last = self._batch(source)
        if source is not None:
            fs.write_text(self.spark, self._batch_path(source), json.dumps({"batch": note["batch"], "undo": undo if note["undoable"] else None}))
        if last is not None and last["undo"] not in (None, undo):
            fs.delete(self.spark, f"{self.path}/{last['undo']}")
        if source is None or not note["undoable"]:
            fs.delete(self.spark, f"{self.path}/{undo}")


__all__ = ["CurrentTable", "PARTITIONS"]
