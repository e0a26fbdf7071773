"""Validation of decoded change records.

Each row gets an ``errors`` array of reasons; a valid row has an empty array.
Checks: the envelope parsed (value is a struct), topic and partition are set,
the key parsed and has no null field, the op is set, and the image the op
needs is present. Schema-level problems (no ``op`` field) are raised when the
plan is built, in ``decode_envelope``.

``fail_on_invalid`` turns the first bad row into a job failure inside the same
pass that writes the data (a filter with ``raise_error``), so checking costs
no extra scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.constants import AFTER, BEFORE, OP, OP_DELETE, PARTITION, TOPIC

ERRORS = "errors"

# Fixed reason codes.
VALUE_NOT_STRUCT = "value_not_struct"
KEY_NOT_STRUCT = "key_not_struct"
TOPIC_NULL = "topic_null"
PARTITION_NULL = "partition_null"
OP_NULL = "op_null"
PK_NULL = "pk_null"
IMAGE_NULL = "image_null"


def reasons(df: DataFrame, key_col: str = "key") -> Column:
    """``array<string>`` of the reasons a decoded record is invalid."""
    checks: list[tuple[Column, str]] = []
    envelope_null = F.col(BEFORE).isNull() & F.col(AFTER).isNull() & F.col(OP).isNull()
    checks.append((envelope_null, VALUE_NOT_STRUCT))
    if TOPIC in df.columns:
        checks.append((F.col(TOPIC).isNull(), TOPIC_NULL))
    if PARTITION in df.columns:
        checks.append((F.col(PARTITION).isNull(), PARTITION_NULL))
    if key_col in df.columns:
        ktype = df.schema[key_col].dataType
        checks.append((F.col(key_col).isNull(), KEY_NOT_STRUCT))
        if isinstance(ktype, T.StructType):
            for f in ktype.fields:
                checks.append((F.col(key_col).isNotNull() & F.col(key_col)[f.name].isNull(), f"{PK_NULL}:{f.name}"))
    checks.append((~envelope_null & F.col(OP).isNull(), OP_NULL))
    needs_before = F.col(OP) == F.lit(OP_DELETE)
    image_missing = F.when(needs_before, F.col(BEFORE).isNull()).otherwise(F.col(AFTER).isNull())
    checks.append((F.col(OP).isNotNull() & image_missing, IMAGE_NULL))
    return F.filter(F.array(*[F.when(cond, F.lit(code)) for cond, code in checks]), lambda x: x.isNotNull())


def validate_changes(df: DataFrame, key_col: str = "key") -> DataFrame:
    """Add the ``errors`` column."""
    return df.withColumn(ERRORS, reasons(df, key_col))


def _guarded(df: DataFrame, errs: Column) -> DataFrame:
    """Filter that raises on the first row with reasons, evaluated once per row.

    The reasons are computed in a projection that also carries a
    non-deterministic marker (the partition id) referenced by the filter. That
    keeps Catalyst from pushing the filter below the projection, which would
    inline the payload parsing (``from_json``) into every reference of the
    condition and parse each record many times.
    """
    marked = df.withColumns({"__errors": errs, "__barrier": F.spark_partition_id()})
    guard = F.when(
        F.size("__errors") > 0,
        F.raise_error(F.concat(F.lit("invalid change record: "), F.array_join("__errors", ","))),
    )
    return marked.filter(guard.isNull() & (F.col("__barrier") >= 0)).drop("__errors", "__barrier")


def fail_on_invalid(df: DataFrame, key_col: str = "key") -> DataFrame:
    """Pass valid rows through; fail the job on the first invalid one."""
    return _guarded(df, reasons(df, key_col))


def schemaless_reasons(df: DataFrame, cdc: bool = True) -> Column:
    """Reasons a decoded schemaless record (``fields`` map, ``op``) is invalid.

    The payload must be a JSON object; with ``cdc`` its op must be set and the
    image the op needs (``before`` for deletes, else ``after``) must be an
    object too. Topic and partition must be set.
    """
    checks: list[tuple[Column, str]] = []
    if TOPIC in df.columns:
        checks.append((F.col(TOPIC).isNull(), TOPIC_NULL))
    if PARTITION in df.columns:
        checks.append((F.col(PARTITION).isNull(), PARTITION_NULL))
    if cdc:
        checks.append((F.col(OP).isNull(), OP_NULL))
        checks.append((F.col(OP).isNotNull() & F.col("fields").isNull(), IMAGE_NULL))
    else:
        checks.append((F.col("fields").isNull(), VALUE_NOT_STRUCT))
    return F.filter(F.array(*[F.when(cond, F.lit(code)) for cond, code in checks]), lambda x: x.isNotNull())


def fail_on_invalid_schemaless(df: DataFrame, cdc: bool = True) -> DataFrame:
    """Pass valid schemaless rows through; fail the job on the first invalid one."""
    return _guarded(df, schemaless_reasons(df, cdc))


def fail_on_invalid_plain(df: DataFrame) -> DataFrame:
    """Pass plain records through; fail the job on one without topic or partition."""
    checks = [(F.col(c).isNull(), code) for c, code in ((TOPIC, TOPIC_NULL), (PARTITION, PARTITION_NULL)) if c in df.columns]
    return _guarded(df, F.filter(F.array(*[F.when(cond, F.lit(code)) for cond, code in checks]), lambda x: x.isNotNull()))
