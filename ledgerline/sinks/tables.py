"""Append-only tables on plain Parquet folders: landing and changelog.

- ``LandingTable``: the rows of every block, partitioned by ``ih_date`` (the day of
  ``ih_datetime``), then ``ih_blockid``. Landing a block replaces its earlier copy,
  so a retried batch leaves one, whatever it holds the second time. Reading a
  block opens its folders and nothing else. Retention drops whole days by
  folder and reads the day of the cutoff alone.
- ``ChangelogTable``: the append-only changelog, a folder per block. Compaction to
  the newest row per key is incremental: a table of the greatest offset per key
  says which blocks hold rows that newer blocks have superseded, and only those
  are rewritten.

Each table has one writer, the driver of its stream. Partitions are replaced as
``sinks.partitions`` describes. The current-state table is ``sinks.current``.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.constants import IH_BLOCKID, IH_DATETIME, IH_OFFSET, LANDING_RETENTION
from ledgerline.functions.temporal import ntz_literal
from ledgerline.operators.maintain import parse_interval
from ledgerline.sinks import fs
from ledgerline.sinks.current import CurrentTable
from ledgerline.sinks.partitions import PartitionedFolder

IH_DATE = "ih_date"
_BLOCK = T.StructField(IH_BLOCKID, T.StringType())
_MAX, _BLOCKS, _OPCOL = "ll_offset", "ll_blocks", "ll_mark_op"


class BlockTable(PartitionedFolder):
    """Rows in a folder per ``ih_blockid``, whatever stands above it."""

    _above = ""  # glob of the folders above a block's

    def _block_dirs(self, block_id: str) -> list[str]:
        return fs.glob_dirs(self.spark, f"{self.path}/{self._above}{IH_BLOCKID}={block_id}")

    def _relative(self, folder: str) -> str:
        return folder[folder.rindex(f"/{self.columns[0].name}=") + 1 :]

    def _placed(self, df: DataFrame) -> DataFrame:
        return df

    def land(self, df: DataFrame, block_id: str | None = None) -> None:
        """Write one block, replacing an earlier copy of it.

        Without ``block_id`` the rows' own ``ih_blockid`` (and day) says which
        folders they replace.
        """
        self.recover()
        if block_id is None:
            self.write(self._placed(df), "overwrite")
            return
        for folder in self._block_dirs(block_id):
            fs.delete(self.spark, folder)
        self.write(self._placed(df.withColumn(IH_BLOCKID, F.lit(block_id))))

    def exists(self) -> bool:
        return fs.exists(self.spark, self.path)

    def schema(self, folder: str = "") -> T.StructType:
        """Of the stored rows, by one partition folder or the table (block ids
        are text, also when they look numeric)."""
        inferred = self.spark.read.option("basePath", self.path).parquet(f"{self.path}/{folder}".rstrip("/")).schema
        names = {c.name for c in self.columns}
        return T.StructType([f for f in inferred.fields if f.name not in names] + [_BLOCK])

    def read(self, block_id: str | None = None, schema: T.StructType | None = None) -> DataFrame:
        """The whole table, or one block (only its folders are listed)."""
        if block_id is None:
            schema = schema or self.schema()
            return self.scan(schema).select(*[F.col(f"`{c}`") for c in schema.names])
        folders = [self._relative(f) for f in self._block_dirs(block_id)]
        schema = schema or self.schema(*folders[:1])
        if not folders:  # a block without rows has no folder
            return self.spark.createDataFrame([], schema)
        return self.scan(schema, *folders).select(*[F.col(f"`{c}`") for c in schema.names])

    def blocks(self) -> list[str]:
        found = fs.glob_dirs(self.spark, f"{self.path}/{self._above}{IH_BLOCKID}=*")
        return sorted({f.rsplit("=", 1)[1] for f in found})


class LandingTable(BlockTable):
    _above = f"{IH_DATE}=*/"

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, [T.StructField(IH_DATE, T.DateType()), _BLOCK])

    def _placed(self, df: DataFrame) -> DataFrame:
        day = F.to_date(IH_DATETIME) if IH_DATETIME in df.columns else F.lit(None).cast("date")
        return df.withColumn(IH_DATE, day)

    def days(self) -> list[str]:
        """The days that have rows; rows without a time are in none of them."""
        prefix = f"{IH_DATE}="
        days = [d[len(prefix):] for d in fs.list_dirs(self.spark, self.path) if d.startswith(prefix)]
        return sorted(d for d in days if d[:1].isdigit())

    def day(self, day: _dt.date) -> DataFrame | None:
        """The rows of one day, or None; no other day is listed."""
        folder = f"{IH_DATE}={day.isoformat()}"
        return self.scan(self.schema(folder), folder) if fs.exists(self.spark, f"{self.path}/{folder}") else None

    def expire(self, now: _dt.datetime, keep: str | _dt.timedelta = LANDING_RETENTION) -> dict:
        """Delete rows with ``ih_datetime < now - keep``; keep null times.

        Days before the cutoff's are dropped as folders, unread. In the
        cutoff's day, blocks that hold nothing else are dropped as folders and
        one with mixed times is replaced by its other rows. Later days, and
        rows without a time, are not looked at. Returns the blocks that are gone
        (``dropped``) and those that lost some of their rows (``rewritten``).
        """
        self.recover()
        if not self.exists():
            return {"dropped": [], "rewritten": []}
        cutoff = now - parse_interval(keep)
        edge = cutoff.date().isoformat()
        hit: set[str] = set()
        for day in [d for d in self.days() if d < edge]:
            hit |= {d.split("=", 1)[1] for d in fs.list_dirs(self.spark, f"{self.path}/{IH_DATE}={day}")}
            fs.delete(self.spark, f"{self.path}/{IH_DATE}={day}")
        rows = self.day(cutoff.date())
        if rows is not None:
            expired = F.col(IH_DATETIME) < ntz_literal(cutoff)
            due = rows.groupBy(IH_BLOCKID).agg(F.count_if(expired).alias("expired"), F.count(F.lit(1)).alias("rows")).where("expired > 0").collect()
            mixed = [r[IH_BLOCKID] for r in due if r["expired"] < r["rows"]]
            for block in [r[IH_BLOCKID] for r in due if r["expired"] == r["rows"]]:
                fs.delete(self.spark, f"{self.path}/{IH_DATE}={edge}/{IH_BLOCKID}={block}")
            if mixed:
                self.replace(rows.where(F.col(IH_BLOCKID).isin(*mixed) & ~expired), [f"{IH_DATE}={edge}/{IH_BLOCKID}={b}" for b in mixed])
            hit |= {r[IH_BLOCKID] for r in due}
        left = set(self.blocks()) if hit else set()
        return {"dropped": sorted(hit - left), "rewritten": sorted(hit & left)}


class ChangelogTable(BlockTable):
    """Append-only changelog; each batch is one ``ih_blockid`` folder."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, [_BLOCK])

    def append(self, df: DataFrame, block_id: str) -> None:
        self.land(df, block_id)

    def truncate(self) -> None:
        """Empty the table (keeps the folder): noted first, so that it happens
        whole, also if the driver is lost on the way."""
        self.recover()
        if self.exists():
            self.replace(self.spark.createDataFrame([], T.StructType([T.StructField("x", T.IntegerType()), _BLOCK])), self._folders(), forget=True)

    def reload(self, df: DataFrame, block_id: str) -> None:
        """Empty the table and append one block, as one step: either both
        happen or neither. Repeated for the same block it changes nothing."""
        self.recover()
        rows = df.withColumn(IH_BLOCKID, F.lit(block_id))
        self.replace(rows, sorted({*self._folders(), f"{IH_BLOCKID}={block_id}"}), forget=True)

    def _folders(self) -> list[str]:
        return [f"{IH_BLOCKID}={b}" for b in self.blocks()] if self.exists() else []

    def done(self, note: dict) -> None:
        if note.get("forget"):  # what was known about the blocks goes with them
            fs.delete(self.spark, f"{self.path}/_marks")
            fs.delete(self.spark, f"{self.path}/_compacted.json")

    # -- compaction ------------------------------------------------------------------

    def _marks(self, keys: Sequence[str]) -> CurrentTable:
        return CurrentTable(self.spark, f"{self.path}/_marks", keys)

    def compact(self, keys: Sequence[str], offset_col: str = IH_OFFSET, keep: Sequence[str] = ()) -> dict:
        """Delete rows whose offset is below their key's greatest.

        ``_marks`` holds, per key, the greatest offset of the blocks compacted so
        far and the blocks that have it. Only blocks that came since are read;
        their keys, looked up in the marks' partitions of those keys, say which
        older blocks hold rows they supersede. Those, and new blocks with rows
        below the greatest, are rewritten; all other folders stay as they are.
        ``keep`` names blocks to leave as they are (a stream's newest, which may yet
        be replayed); they supersede rows of others all the same. Rows without
        a whole key or an offset stay.
        """
        self.recover()
        text = fs.read_text(self.spark, f"{self.path}/_compacted.json") if self.exists() else None
        known = set(json.loads(text)["blocks"]) if text else set()
        blocks = set(self.blocks()) if self.exists() else set()
        new, held = sorted(blocks - known - set(keep)), sorted(blocks & set(keep))
        if not new and not held:
            return {"new": [], "rewritten": []}
        keys, schema = list(keys), self.schema(f"{IH_BLOCKID}={[*new, *held][0]}")
        offset = F.expr(f"try_cast(`{offset_col}` AS BIGINT)")  # changelog offsets are stored as text
        key = [F.col(f"`{k}`") for k in keys]
        whole = offset.isNotNull()
        for k in key:
            whole = whole & k.isNotNull()

        def rows_of(names: Sequence[str]) -> DataFrame:
            return self.scan(schema, *[f"{IH_BLOCKID}={b}" for b in names])

        latest = rows_of([*new, *held]).where(whole).groupBy(*key, IH_BLOCKID).agg(F.max(offset).alias("ll_most"), F.min(offset).alias("ll_least"))
        top = latest.groupBy(*keys).agg(F.max("ll_most").alias(_MAX))
        marks = self._marks(keys)
        if marks.exists():
            old = marks.lookup(top, keys).select(*key, F.col(_MAX).alias("ll_old"), F.col(_BLOCKS).alias("ll_old_blocks"))
            top = top.join(old, keys, "left").withColumn(_MAX, F.greatest(_MAX, "ll_old"))
        else:
            top = top.withColumn("ll_old", F.lit(None).cast("bigint")).withColumn("ll_old_blocks", F.array().cast("array<string>"))
        ours = ~F.col(IH_BLOCKID).isin(held) if held else F.lit(True)
        per_key = latest.join(top, keys).groupBy(*keys).agg(
            F.first(_MAX).alias(_MAX), F.first("ll_old").alias("ll_old"), F.first("ll_old_blocks").alias("ll_old_blocks"),
            F.sort_array(F.collect_set(F.when(ours & (F.col("ll_most") == F.col(_MAX)), F.col(IH_BLOCKID)))).alias("ll_now"),
            F.sort_array(F.collect_set(F.when(ours & (F.col("ll_least") < F.col(_MAX)), F.col(IH_BLOCKID)))).alias("ll_stale"),
        )
        path = f"{self.path}/_limits"
        per_key.write.mode("overwrite").parquet(path)
        per_key = self.spark.read.schema(per_key.schema).parquet(path)
        none = F.array().cast("array<string>")
        passed = F.when(F.col("ll_old") < F.col(_MAX), F.col("ll_old_blocks")).otherwise(none)
        # names of blocks, at most all there are
        rewrite = sorted(r[0] for r in per_key.select(F.explode(F.concat("ll_stale", passed))).distinct().collect() if r[0] in blocks)
        if rewrite:
            kept = rows_of(rewrite).join(per_key.select(*keys, _MAX), keys, "left")
            kept = kept.where(~F.coalesce(offset < F.col(_MAX), F.lit(False))).select(*[F.col(f"`{c}`") for c in schema.names])
            self.replace(kept, [f"{IH_BLOCKID}={b}" for b in rewrite])
        still = F.when(F.col("ll_old") == F.col(_MAX), F.col("ll_old_blocks")).otherwise(none)
        marks.apply(per_key.select(*key, _MAX, F.array_union(still, "ll_now").alias(_BLOCKS), F.lit("u").alias(_OPCOL)), op_col=_OPCOL)
        fs.write_text(self.spark, f"{self.path}/_compacted.json", json.dumps({"blocks": sorted((known | set(new)) & set(self.blocks()))}))
        fs.delete(self.spark, path)
        return {"new": new, "rewritten": rewrite}


__all__ = ["ChangelogTable", "IH_DATE", "LandingTable"]
