"""Decoding of change records.

Typed envelope: ``value`` holds ``{before: row, after: row, op: string}`` and
``key`` a struct whose fields are the primary key, in schema order. Text
payloads (JSON, the schemaless converter's output) are parsed with
``from_json``; payloads that are already structs pass through. Bad JSON
decodes to a null envelope / key, which ``validate_changes`` reports.

Schemaless records decode to ``map<string,string>``; nested values stay JSON
text. Field lookups on them ignore case and take the last matching key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.constants import AFTER, BEFORE, OP

MAP_OF_TEXT = T.MapType(T.StringType(), T.StringType())


def envelope_schema(row_schema: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField(BEFORE, row_schema, True),
            T.StructField(AFTER, row_schema, True),
            T.StructField(OP, T.StringType(), True),
        ]
    )


_CORRUPT = "__corrupt_record"


def _parse(df: DataFrame, col: str, schema: T.StructType, fmt: str) -> tuple[Column, Column | None]:
    """(parse expression, rebuild function input) for a payload column.

    Text is parsed with a corrupt-record field, so malformed input is told
    apart from a struct whose fields are null.
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.StructType):
        return F.col(f"`{col}`"), None
    if fmt == "avro":
        return _from_avro(F.col(f"`{col}`"), schema), None
    if fmt != "json":
        raise ValueError(f"unsupported payload format {fmt!r}")
    text = F.col(f"`{col}`").cast("string") if isinstance(dtype, T.BinaryType) else F.col(f"`{col}`")
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(_CORRUPT, T.StringType(), True)])
    parsed = F.from_json(text, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    return parsed, text


def avro_schema(schema: T.StructType, name: str = "record") -> str:
    """Avro schema JSON for a Spark struct of flat, nullable primitive fields."""
    import json

    kinds = {
        T.StringType: "string", T.LongType: "long", T.IntegerType: "int", T.DoubleType: "double",
        T.FloatType: "float", T.BooleanType: "boolean", T.BinaryType: "bytes",
    }

    def field_type(dt, path):
        if isinstance(dt, T.StructType):
            return json.loads(avro_schema(dt, path))
        for cls, kind in kinds.items():
            if isinstance(dt, cls):
                return kind
        raise ValueError(f"no Avro mapping for {dt}")

    fields = [{"name": f.name, "type": ["null", field_type(f.dataType, f"{name}_{f.name}")], "default": None} for f in schema.fields]
    return json.dumps({"type": "record", "name": name, "fields": fields})


def _from_avro(col: Column, schema: T.StructType) -> Column:
    """Avro binary payload -> struct; needs the external spark-avro module."""
    try:
        from pyspark.sql.avro.functions import from_avro
    except ImportError as exc:  # pragma: no cover - depends on deployment
        raise RuntimeError("Avro payloads need the spark-avro module on the classpath") from exc
    return from_avro(col, avro_schema(schema), {"mode": "PERMISSIVE"})


def _rebuild(raw: str, schema: T.StructType, text_col: str | None) -> Column:
    """Null for missing or malformed payloads, else the struct without the corrupt field."""
    if text_col is None:
        return F.col(raw)
    ok = F.col(text_col).isNotNull() & F.col(raw).isNotNull() & F.col(raw)[_CORRUPT].isNull()
    return F.when(ok, F.struct(*[F.col(raw)[f.name].alias(f.name) for f in schema.fields]))


def decode_envelope(
    df: DataFrame,
    row_schema: T.StructType | None = None,
    key_schema: T.StructType | None = None,
    value_col: str = "value",
    key_col: str = "key",
    fmt: str = "json",
) -> DataFrame:
    """Parse ``value`` into ``before, after, op`` and ``key`` into a struct.

    The op is lower-cased once here, so ``D`` deletes like ``d``. An envelope
    schema without ``op`` is rejected when the plan is built. Missing or
    malformed payloads decode to null (reported by ``validate_changes``).
    """
    vtype = df.schema[value_col].dataType
    if isinstance(vtype, T.StructType):
        names = [f.name for f in vtype.fields]
        if OP not in names:
            raise ValueError(f"field '{OP}' not found in value schema")
        env_schema = vtype
    else:
        if row_schema is None:
            raise ValueError("row_schema is required to decode text payloads")
        env_schema = envelope_schema(row_schema)
    cols = [c for c in df.columns if c not in (value_col, key_col)]
    first = [F.col(f"`{c}`") for c in cols]
    env, env_text = _parse(df, value_col, env_schema, fmt)
    first += [env.alias("__env_raw")] + ([F.col(f"`{value_col}`").alias("__env_text")] if env_text is not None else [])
    key_schema_used = None
    key_text = None
    if key_col in df.columns:
        ktype = df.schema[key_col].dataType
        if not isinstance(ktype, T.StructType) and key_schema is None:
            raise ValueError("key_schema is required to decode text keys")
        key_schema_used = key_schema or ktype
        key, key_text = _parse(df, key_col, key_schema_used, fmt)
        first += [key.alias("__key_raw")] + ([F.col(f"`{key_col}`").alias("__key_text")] if key_text is not None else [])
    # parse once per row into columns, then rebuild and split them
    parsed = df.select(*first)
    second = [F.col(f"`{c}`") for c in cols]
    if key_schema_used is not None:
        second.append(_rebuild("__key_raw", key_schema_used, "__key_text" if key_text is not None else None).alias("key"))
    second.append(_rebuild("__env_raw", env_schema, "__env_text" if env_text is not None else None).alias("__env"))
    rebuilt = parsed.select(*second)
    keep = [F.col(f"`{c}`") for c in rebuilt.columns if c != "__env"]
    return rebuilt.select(
        *keep,
        F.col("__env")[BEFORE].alias(BEFORE),
        F.col("__env")[AFTER].alias(AFTER),
        F.lower(F.col("__env")[OP]).alias(OP),
    )


SCHEMALESS_ENVELOPE = T.StructType(
    [
        T.StructField(OP, T.StringType(), True),
        T.StructField(BEFORE, MAP_OF_TEXT, True),
        T.StructField(AFTER, MAP_OF_TEXT, True),
    ]
)


def decode_schemaless(df: DataFrame, cdc: bool = True, value_col: str = "value") -> DataFrame:
    """Parse a schemaless JSON payload into a ``fields`` text map (and ``op``).

    With ``cdc=True`` the payload is ``{op, before, after}``: its shape is
    fixed even though the row's fields are not, so one ``from_json`` into
    ``struct<op, before: map, after: map>`` parses each record once, and
    ``fields`` is ``before`` for deletes, else ``after``. Plain records get op
    ``c`` later. Nested values stay JSON text.
    """
    cols = [F.col(f"`{c}`") for c in df.columns if c != value_col]
    if not cdc:
        payload = F.from_json(F.col(value_col), MAP_OF_TEXT, {"mode": "PERMISSIVE"})
        return df.select(*cols, payload.alias("fields"))
    parsed = df.select(*cols, F.from_json(F.col(value_col), SCHEMALESS_ENVELOPE, {"mode": "PERMISSIVE"}).alias("__payload"))
    op = F.lower(F.col("__payload")[OP])
    image = F.when(op == "d", F.col("__payload")[BEFORE]).otherwise(F.col("__payload")[AFTER])
    return parsed.select(*[F.col(f"`{c}`") for c in df.columns if c != value_col], image.alias("fields"), op.alias(OP))


def lowered_entries(map_col) -> Column:
    """``array<struct<key, value>>`` of a text map with lower-cased keys, in order."""
    m = F.col(map_col) if isinstance(map_col, str) else map_col
    return F.transform(F.map_entries(m), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))


def entry_lookup(entries_col, name: str) -> Column:
    """Value of ``name`` among lowered entries; the last match wins."""
    e = F.col(entries_col) if isinstance(entries_col, str) else entries_col
    hits = F.filter(e, lambda x: x["key"] == F.lit(name.strip().lower()))
    return F.try_element_at(hits, F.lit(-1))["value"]


def fields_by_name(map_col, names) -> Column:
    """A struct of the values of ``names`` (lower-cased, trimmed) in a text map,
    ignoring case; the last match wins. ``field_value`` reads a value from it.

    One pass over the entries, however many names there are: the map is written as
    one JSON object, lower-cased as a whole, and parsed into the struct, where a
    later value of a key replaces an earlier one. Values are in hexadecimal, which
    has no case to lose; the text escapes no letter, and quotes part the keys, so
    each is lower-cased as it would be alone. A lookup or a JSON object per name
    would cost several times as much.
    """
    m = F.col(map_col) if isinstance(map_col, str) else map_col
    wanted = T.StructType([T.StructField(n, T.StringType()) for n in dict.fromkeys(x.strip().lower() for x in names)])
    text = F.to_json(F.transform_values(m, lambda _, v: F.hex(v)), {"ignoreNullFields": "false"})
    return F.from_json(F.lower(text), wanted)


def field_value(fields_col: str, name: str) -> Column:
    """The value of ``name`` in a struct that ``fields_by_name`` made."""
    return F.unhex(F.col(fields_col)[name.strip().lower()]).cast("string")


def primary_key(schema: T.StructType, key_col: str = "key") -> list[str]:
    """Primary-key field names, in the key schema's order."""
    ktype = schema[key_col].dataType
    if not isinstance(ktype, T.StructType):
        raise ValueError("key must be a struct")
    return [f.name for f in ktype.fields]
