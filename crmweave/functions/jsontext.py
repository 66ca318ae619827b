"""JSON text building."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T



def quoted(name: str) -> str:
    """A column name as SQL, also where it holds dots or brackets."""
    return "`" + name.replace("`", "``") + "`"


def json_with_nulls(fields: list[str]) -> Column:
    """One JSON object of the SQL expressions, null fields written as ``null``."""
    return F.expr(f"to_json(struct({', '.join(fields)}), map('ignoreNullFields', 'false'))")


def is_json_sql(text: str) -> str:
    """SQL that is true where the text is one whole JSON value.

    Spark's JSON functions stop at the end of the first value. Text that is still one value
    inside brackets has nothing after it, save text that closes the bracket itself; that is
    told by the same test inside an object.
    """
    strict = "map('allowSingleQuotes', 'false')"
    in_array = f"size(from_json(concat('[', {text}, ']'), 'array<string>', {strict})) = 1"
    in_object = (
        f"size(from_json(concat('{{\"v\":', {text}, '}}'), 'map<string,string>', {strict})) = 1"
    )
    return rf"({in_array} AND (NOT {text} RLIKE r'\]\s*\S' OR {in_object}))"


def json_with_bools(schema: T.StructType) -> Column:
    """JSON object of a frame's columns, null fields kept, with bool words as booleans.

    String leaves ``true``/``false``, in any case, become JSON booleans.
    """
    return F.expr(f"to_json({_bool_struct('', schema)}, map('ignoreNullFields', 'true'))")


def _is_bool_word(text: str) -> str:
    return f"lower({text}) IN ('true', 'false')"


def _bool_struct(prefix: str, schema: T.StructType) -> str:
    """A struct that names a field once per form its value can take.

    At most one of them is not null in a row, and ``to_json`` leaves out null fields, so each
    field is written once: as text, as boolean, or as a JSON null.
    """
    forms = []
    for field in schema.fields:
        name = quoted(field.name)
        value = f"{prefix}{name}"
        if isinstance(field.dataType, T.StringType):
            forms.append(f"CASE WHEN NOT {_is_bool_word(value)} THEN {value} END AS {name}")
            forms.append(
                f"CASE WHEN {_is_bool_word(value)} THEN lower({value}) = 'true' END AS {name}"
            )
        else:
            forms.append(f"{_bool_value(value, field.dataType)} AS {name}")
        forms.append(f"CASE WHEN {value} IS NULL THEN parse_json('null') END AS {name}")
    return f"struct({', '.join(forms)})"


def _bool_value(value: str, dtype: T.DataType, depth: int = 0) -> str:
    if isinstance(dtype, T.StringType):
        word = f"parse_json(lower({value}))"
        return f"CASE WHEN {_is_bool_word(value)} THEN {word} ELSE cast({value} AS variant) END"
    if isinstance(dtype, T.StructType):
        return f"CASE WHEN {value} IS NOT NULL THEN {_bool_struct(f'{value}.', dtype)} END"
    if isinstance(dtype, T.ArrayType):
        x = f"b{depth}"
        return f"transform({value}, {x} -> {_bool_value(x, dtype.elementType, depth + 1)})"
    if isinstance(dtype, T.MapType):
        k, v = f"c{depth}", f"d{depth}"
        inner = _bool_value(v, dtype.valueType, depth + 1)
        return f"transform_values({value}, ({k}, {v}) -> {inner})"
    return value


def splice(field: str, json: Column, rest: Column) -> Column:
    """Put already serialised ``json`` in front of the object ``rest`` as field ``field``."""
    tail = F.when(rest == "{}", F.lit("}")).otherwise(
        F.concat(F.lit(","), F.substr(rest, F.lit(2)))
    )
    merged = F.concat(F.lit(f'{{"{field}":'), json, tail)
    return F.when(json.isNull(), rest).otherwise(merged)
