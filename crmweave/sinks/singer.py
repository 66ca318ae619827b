"""SCHEMA and RECORD message lines."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmweave.functions.jsontext import quoted, splice
from crmweave.functions.text import named

# The type list of a column, before what its values add.
SCALAR_TYPES = ["null", "boolean", "string", "integer", "number"]

SCHEMA_FOLDER, RECORDS_FOLDER = "0-schema", "1-records"

# Columns that hold JSON text, by the JSON types of their values.
JsonColumns = dict[str, str | tuple[str, ...]]


def singer_records(
    df: DataFrame, stream: str, json_columns: Iterable[str] | None = None
) -> DataFrame:
    """One RECORD line per row as ``line``; null top-level fields are left out.

    JSON text columns are embedded as they are, so nulls inside them stay. JSON has no
    decimals, so those leave as text, with all their digits.
    """
    embedded = list(json_columns or ())
    plain = [
        f"{_decimals_as_text(quoted(f.name), f.dataType)} AS {quoted(f.name)}"
        for f in df.schema.fields
        if f.name not in embedded
    ]
    record = F.lit("{}")
    if plain:
        record = F.expr(f"to_json(struct({', '.join(plain)}), map('ignoreNullFields', 'true'))")
    for name in reversed(embedded):
        record = splice(name, named(name), record)
    head = f'{{"type":"RECORD","stream":{json.dumps(stream, ensure_ascii=False)},"record":'
    return df.select(F.concat(F.lit(head), record, F.lit("}")).alias("line"))


def _decimals_as_text(value: str, dtype: T.DataType, depth: int = 0) -> str:
    """SQL of a value with every decimal in it as text."""
    if isinstance(dtype, T.DecimalType):
        return f"cast({value} AS string)"
    if "decimal" not in dtype.simpleString():
        return value
    if isinstance(dtype, T.ArrayType):
        x = f"x{depth}"
        return f"transform({value}, {x} -> {_decimals_as_text(x, dtype.elementType, depth + 1)})"
    if isinstance(dtype, T.MapType):
        k, v = f"k{depth}", f"v{depth}"
        inner = _decimals_as_text(v, dtype.valueType, depth + 1)
        return f"transform_values({value}, ({k}, {v}) -> {inner})"
    fields = ", ".join(
        f"{_decimals_as_text(f'{value}.{quoted(f.name)}', f.dataType, depth)} AS {quoted(f.name)}"
        for f in dtype.fields
    )
    return f"CASE WHEN {value} IS NOT NULL THEN struct({fields}) END"


def _column_types(dtype: T.DataType, json_types: str | tuple[str, ...] | None) -> list[str]:
    types = list(SCALAR_TYPES)
    if isinstance(dtype, (T.StructType, T.MapType)) or "object" in (json_types or ()):
        types.append("object")
    if isinstance(dtype, T.ArrayType) or "array" in (json_types or ()):
        types.append("array")
    return types


def singer_schema(df: DataFrame, stream: str, json_columns: JsonColumns | None = None) -> str:
    """The stream's SCHEMA line, from the frame's schema and the types of its JSON text."""
    return _schema_line(
        stream,
        {
            f.name: _column_types(f.dataType, (json_columns or {}).get(f.name))
            for f in df.schema.fields
        },
    )


def _schema_line(stream: str, types: dict[str, list[str]]) -> str:
    properties = {name: {"type": listed} for name, listed in types.items()}
    message = {
        "type": "SCHEMA",
        "stream": stream,
        "schema": {"type": "object", "properties": properties},
        "key_properties": [],
    }
    return json.dumps(message, ensure_ascii=False, separators=(",", ":"))


def _opens_with(name: str, char: str) -> Column:
    """Whether any text of a column starts with a character, blanks aside."""
    seen = F.bool_or(F.startswith(F.ltrim(named(name)), F.lit(char)))
    return F.coalesce(seen, F.lit(False))


def observed_types(df: DataFrame, json_columns: tuple[str, ...]) -> DataFrame:
    """(column_name, has_object, has_array) of JSON text columns, from all their values."""
    kinds = [
        F.struct(
            F.lit(name).alias("column_name"),
            _opens_with(name, "{").alias("has_object"),
            _opens_with(name, "[").alias("has_array"),
        )
        for name in json_columns
    ]
    return df.agg(F.array(*kinds).alias("kinds")).select(F.inline("kinds"))


def write_singer(
    df: DataFrame,
    stream: str,
    output_dir: str,
    json_columns: Iterable[str] = (),
    mode: str = "errorifexists",
) -> str | None:
    """Write a stream's lines to its own directory; the path, or None without any record.

    ``json_columns`` hold JSON text. The records go out in one pass, in which all their values
    are seen, so the SCHEMA line has the types that they have. What was written, not the plan,
    is then asked whether there are records; if so the SCHEMA line follows, in a folder that
    sorts before the records.
    """
    names = list(json_columns)
    seen = Observation(f"{stream}-{uuid.uuid4().hex}")
    if names:
        kinds = [
            _opens_with(name, char).alias(f"{kind}{i}")
            for i, name in enumerate(names)
            for kind, char in (("object", "{"), ("array", "["))
        ]
        df = df.observe(seen, *kinds)
    spark = df.sparkSession
    path = f"{output_dir}/{stream}"
    singer_records(df, stream, names).write.mode(mode).text(f"{path}/{RECORDS_FOLDER}")
    if spark.read.text(f"{path}/{RECORDS_FOLDER}").isEmpty():
        return None
    found = seen.get if names else {}
    types = {
        name: tuple(kind for kind in ("object", "array") if found[f"{kind}{i}"])
        for i, name in enumerate(names)
    }
    line = F.lit(singer_schema(df, stream, types)).alias("line")
    spark.range(0, 1, 1, 1).select(line).write.mode(mode).text(f"{path}/{SCHEMA_FOLDER}")
    return path
