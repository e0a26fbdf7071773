"""Staged compressed CSV export and load.

Export: one CSV line per row (see ``functions.text``), written with the text
writer and gzip, one file per partition, into a run-scoped stage folder.
Load: every field read as text, then coerced to the target column's type, so
the target schema does the typing the way a warehouse COPY does. Purging the
stage happens only after the load has been committed to a table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.text import csv_line
from ledgerline.sinks import fs

# A line of one null field would be blank, and blank lines are no rows to a CSV
# reader: a table of one column is staged with an empty second field.
_PAD = "ll_pad"


def csv_lines(df: DataFrame, columns: Sequence[str] | None = None, name: str = "line") -> DataFrame:
    """One-column DataFrame of CSV lines."""
    line = csv_line(df, columns)
    if len(columns if columns is not None else df.columns) == 1:
        line = F.concat(line, F.lit(','))
    return df.select(line.alias(name))


def stage_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, compression: str = "gzip") -> str:
    """Write ``df`` as header-less quoted CSV text files under ``path``."""
    csv_lines(df, columns).write.mode("overwrite").option("compression", compression).text(path)
    return path


def _from_text(text: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.BinaryType):
        return F.unbase64(text)
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(text, dtype)
    if isinstance(dtype, T.BooleanType):
        return F.lower(text).cast("boolean")
    if isinstance(dtype, T.TimestampType):
        # staged as UTC wall clock, whatever the session's zone
        return F.concat(text, F.lit("Z")).cast(dtype)
    return text.cast(dtype)


def load_staged(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read staged CSV files back with ``schema``.

    Multi-line quoted fields are allowed, so each (gzip) file is one task; a
    stage has as many files as the write that made it has tasks. A bare empty
    field is null and a quoted one is text: null is read as a fresh random
    word, which no text equals, and line ends inside quotes stay as they are.
    """
    names = [f.name for f in schema.fields] + [_PAD] * (len(schema.fields) == 1)
    text_schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    raw = (
        spark.read.schema(text_schema)
        .option("header", "false")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", "true")
        .option("nullValue", uuid.uuid4().hex)
        .option("lineSep", "\n")
        .option("emptyValue", "")
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return raw.select(*[_from_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields])


def purge_stage(spark: SparkSession, path: str) -> bool:
    """Remove a stage folder (call after the load is committed)."""
    return fs.delete(spark, path)


def copy_into_landing(
    spark: SparkSession,
    stage_path: str,
    landing,
    schema: T.StructType,
    purge: bool = True,
    block_id: str | None = None,
) -> None:
    """Load staged files into a landing table (one block), then purge the stage.

    ``landing`` is a ``sinks.tables.LandingTable``; without ``block_id`` the
    rows must carry their ``ih_blockid``. The purge runs only after the landing write committed.
    """
    landing.land(load_staged(spark, stage_path, schema), block_id)
    if purge:
        purge_stage(spark, stage_path)
