"""Value-to-text and CSV line expressions for the staged export.

A field is its text wrapped in double quotes with inner quotes doubled; a
null is a bare empty field, so null and ``''`` stay distinct. Spark's own CSV
writer cannot express that (``quoteAll`` writes null as ``""``), so the line
is built as one string column and written with the text writer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.temporal import epoch_ntz, local_datetime_text


def value_text(col: Column, dtype: T.DataType) -> Column:
    """The text form of a value of type ``dtype``."""
    if isinstance(dtype, T.StringType):
        return col
    if isinstance(dtype, T.TimestampNTZType):
        return local_datetime_text(col)
    if isinstance(dtype, T.TimestampType):
        return local_datetime_text(F.timestamp_add("MICROSECOND", F.unix_micros(col), epoch_ntz()))
    if isinstance(dtype, T.BinaryType):
        return F.base64(col)
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(col)
    return col.cast("string")


def quote_field(text: Column) -> Column:
    """``"text"`` with inner quotes doubled; null stays null."""
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def csv_line(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """One CSV line (without newline) over ``columns`` of ``df``, in order."""
    names = list(columns) if columns is not None else df.columns
    fields = {f.name: f.dataType for f in df.schema.fields}
    parts = [F.coalesce(quote_field(value_text(F.col(f"`{n}`"), fields[n])), F.lit("")) for n in names]
    return F.concat_ws(",", *parts)
