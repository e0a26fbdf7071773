"""Append-only tables of the session's catalog (Parquet, managed).

The same steps as on plain folders, as statements of the catalog: load rows by
an explicit column list, whatever the table's column order; empty the table;
drop partitions by name, which reads nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerline.sinks.staging import load_staged, purge_stage


_NULL = "__HIVE_DEFAULT_PARTITION__"


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


class CatalogTable:
    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.name = name

    def create(self, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(self.name)} ({columns}) USING parquet{parts}")

    def load(self, rows: DataFrame, columns: Sequence[str] | None = None) -> None:
        """Append ``rows``; ``columns`` (default: theirs) names the table's column
        for each of the frame's, in the frame's order. Columns of the table that
        are not named become null."""
        view = f"ll_load_{uuid.uuid4().hex}"
        rows.createOrReplaceTempView(view)
        try:
            named = ", ".join(f"`{c}`" for c in columns or rows.columns)
            self.spark.sql(f"INSERT INTO {_quoted(self.name)} ({named}) SELECT * FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)

    def copy_into(self, stage_path: str, schema: T.StructType, purge: bool = True) -> None:
        """Load staged files by the stage's column list, then purge the stage."""
        self.load(load_staged(self.spark, stage_path, schema), schema.names)
        if purge:
            purge_stage(self.spark, stage_path)

    def truncate(self) -> None:
        self.spark.sql(f"TRUNCATE TABLE {_quoted(self.name)}")

    def drop_partition(self, **values) -> None:
        """Drop the partitions with these values of some of the partition
        columns (names alone are listed); no partition: nothing happens."""
        listed = self.spark.sql(f"SHOW PARTITIONS {_quoted(self.name)} PARTITION ({_spec(values)})").collect()
        named = [dict(part.split("=", 1) for part in r["partition"].split("/")) for r in listed]
        found = [_spec({k: None if v == _NULL else unquote(v) for k, v in n.items()}) for n in named]
        if found:
            every = ", ".join(f"PARTITION ({spec})" for spec in found)
            self.spark.sql(f"ALTER TABLE {_quoted(self.name)} DROP IF EXISTS {every}")

    def read(self) -> DataFrame:
        return self.spark.table(_quoted(self.name))


def _spec(values: dict) -> str:
    return ", ".join(f"`{k}` = {_literal(v)}" for k, v in values.items())


def _literal(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


__all__ = ["CatalogTable"]
