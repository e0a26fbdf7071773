"""Target-column discovery.

The target table's column list drives the projection of every record. It is
read once per query start from the catalog (or a schema / DataFrame), in
ordinal order; an empty list is an error; the ignore list is applied after
that check and compares names exactly.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerline.constants import IH_COLUMNS
from ledgerline.functions.names import distinct as _distinct
from ledgerline.functions.names import norm, remove_exact


def target_schema(spark: SparkSession | None, target) -> T.StructType:
    """Schema of a table name, a path-less DataFrame, or a schema."""
    if isinstance(target, T.StructType):
        return target
    if isinstance(target, DataFrame):
        return target.schema
    if isinstance(target, str):
        if spark is None:
            raise ValueError("a session is needed to look up a table")
        return spark.table(target).schema
    raise TypeError(f"cannot read columns of {type(target).__name__}")


def target_columns(
    spark: SparkSession | None,
    target,
    ignore: Iterable[str] | None = None,
    distinct: bool = False,
    upper: bool = False,
) -> list[str]:
    """Ordered column names of the target, minus ``ignore`` (exact case)."""
    names = [f.name for f in target_schema(spark, target).fields]
    if not names:
        raise ValueError(f"empty column list for target {target!r}")
    if upper:
        names = [n.upper() for n in names]
    names = remove_exact(names, ignore)
    if distinct:
        names = _distinct(names)
    return names


def final_columns(landing_columns: Sequence[str], exclude: Iterable[str] | None = None) -> list[str]:
    """Final-table columns: the landing columns minus the provenance ones.

    ``exclude`` defaults to the six ``ih_*`` columns, matched ignoring case.
    """
    drop = {norm(c) for c in (exclude if exclude is not None else IH_COLUMNS)}
    return [c for c in landing_columns if norm(c) not in drop]


def require_columns(available: Sequence[str], needed: Sequence[str], what: str = "landing table") -> None:
    """Raise if a needed column is missing (ignoring case)."""
    have = {norm(a) for a in available}
    missing = [n for n in needed if norm(n) not in have]
    if missing:
        raise ValueError(f"columns {missing} are missing from the {what}")
