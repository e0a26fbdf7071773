"""Replacing partitions of a partitioned Parquet folder.

Spark's dynamic partition overwrite replaces the partitions that a write has
rows for, and those alone. Two things are added here: partitions that are left
without rows go too, and a driver lost while the overwrite commits loses
nothing. The new rows of the partitions are written to a staged folder first;
once that write has committed, a small note names the staged folder and the
partitions it stands for; then the staged rows overwrite them. Whoever opens
the table next finds the note of a lost driver and does the last step again,
which changes nothing that was already done.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerline.sinks import fs


class PartitionedFolder:
    """One writer's view of the folder ``path``, partitioned by ``columns``."""

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[T.StructField]):
        self.spark = spark
        self.path = path.rstrip("/")
        self.columns = list(columns)

    @property
    def _note(self) -> str:
        return f"{self.path}/_replace.json"

    def write(self, rows: DataFrame, mode: str = "append") -> None:
        names = [c.name for c in self.columns]
        rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*names).parquet(self.path)

    def scan(self, schema: T.StructType, *folders: str) -> DataFrame:
        """Rows of the given partition folders (globs; none given: all); only
        those folders are listed."""
        data = [f for f in schema.fields if f.name not in {c.name for c in self.columns}]
        reader = self.spark.read.option("basePath", self.path).schema(T.StructType(data + self.columns))
        return reader.parquet(*([f"{self.path}/{f}" for f in folders] or [self.path]))

    def replace(self, rows: DataFrame, touched: Sequence[str], **also) -> None:
        """Make ``rows`` all there is in the partition folders ``touched``
        (relative; rows of others must not be among them). ``also`` is handed
        to ``done`` with the rest of the note."""
        staged = f"_staged/{uuid.uuid4().hex}"
        rows.write.partitionBy(*[c.name for c in self.columns]).parquet(f"{self.path}/{staged}")
        self.put(staged, rows.schema, touched, **also)

    def put(self, staged: str, schema: T.StructType, touched: Sequence[str], **also) -> None:
        """The same for rows that are written already, partitioned alike,
        under ``staged`` (relative to the table; dropped when done)."""
        note = {"staged": staged, "schema": schema.json(), "touched": sorted(touched)} | also
        fs.write_text(self.spark, self._note + ".tmp", json.dumps(note))
        if not fs.rename(self.spark, self._note + ".tmp", self._note):
            raise RuntimeError(f"another writer replaces partitions of {self.path}")
        self.recover()

    def done(self, note: dict) -> None:
        """What else belongs to a replacement; it may be done twice."""

    def recover(self) -> None:
        """Finish a replacement that was noted."""
        text = fs.read_text(self.spark, self._note)
        if text is None:
            return
        note = json.loads(text)
        root = f"{self.path}/{note['staged']}"
        full = [t for t in note["touched"] if fs.exists(self.spark, f"{root}/{t}")]
        if full:
            data = [f for f in T.StructType.fromJson(json.loads(note["schema"])).fields if f.name not in {c.name for c in self.columns}]
            staged = self.spark.read.schema(T.StructType(data + self.columns)).parquet(root)
            self.write(staged, "overwrite")
        for folder in set(note["touched"]) - set(full):
            fs.delete(self.spark, f"{self.path}/{folder}")
        self.done(note)
        fs.delete(self.spark, root)
        fs.delete(self.spark, self._note)


__all__ = ["PartitionedFolder"]
