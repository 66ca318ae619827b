"""Repairs that keep values readable for strict JSON consumers downstream.

The functions take a SQL expression as text; a column name is one. Cleaning a record means one
such expression per column, which is built as text so that a wide record stays cheap to plan.
"""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmweave.functions.jsontext import quoted


# Tokens, time format, and the comma-number forms.
NONFINITE_TOKENS = ["NaN", "Infinity", "-Infinity"]
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
LITERAL_SPACE = " \t\r\n\x0c"
GROUPED_NUMBER = (
    r"^[+-]?(?:0+|[1-9][0-9]*)(?:,(?:0+|[1-9][0-9]*))*"
    r"(?:,(?:0+|[1-9][0-9]*)?|,[0-9]*\.[0-9]+)$"
)
DECIMAL_COMMA = r"^[+-]?[0-9]+,[0-9]{1,2}$"
# A literal of the container kind needs one of these characters ...
CONTAINER_HINT = r"[,\[{(]"
# ... and cannot open with a letter, save a string prefix or a named constant.
LITERAL_START = r"^\s*(?:[^A-Za-z\s]|[bBfFrRuU]{1,2}['\x22]|None|True|False|set)"

_TOKENS = ", ".join(f"'{t}'" for t in NONFINITE_TOKENS)


def _bare(text: str) -> str:
    return f"btrim({text}, '{LITERAL_SPACE}')"


def _is_comma_number(text: str) -> str:
    return (
        f"(contains({text}, ',') AND {_bare(text)} RLIKE r'{GROUPED_NUMBER}'"
        f" AND NOT {_bare(text)} RLIKE r'{DECIMAL_COMMA}')"
    )


def _sanitize(text: str) -> str:
    return (
        f"CASE WHEN {text} IN ({_TOKENS}) THEN NULL"
        f" WHEN {_is_comma_number(text)} THEN replace({_bare(text)}, ',', '') ELSE {text} END"
    )


def _iso(ts: str) -> str:
    return f'date_format({ts}, "{ISO_FORMAT}")'


def iso_timestamp(ts: str) -> Column:
    """Instant in UTC as ISO 8601 with microseconds; null stays null."""
    return F.expr(_iso(ts))


def is_nonfinite(text: str) -> Column:
    """True for text that is exactly a non-finite number token."""
    return F.expr(f"{text} IN ({_TOKENS})")


def null_nonfinite(text: str) -> Column:
    """Null for text that is exactly a non-finite number token."""
    return F.expr(f"CASE WHEN {text} IN ({_TOKENS}) THEN NULL ELSE {text} END")


def is_comma_number(text: str) -> Column:
    """True where text is a number with grouping commas that is safe to rewrite.

    Leading zeros and one comma before one or two digits (a decimal comma) are not safe.
    """
    return F.expr(_is_comma_number(text))


def repair_comma_number(text: str) -> Column:
    """Take the commas out of a grouped number; other text is unchanged."""
    return F.expr(
        f"CASE WHEN {_is_comma_number(text)} THEN replace({_bare(text)}, ',', '') ELSE {text} END"
    )


def sanitize_text(text: str) -> Column:
    """``null_nonfinite`` then ``repair_comma_number``."""
    return F.expr(_sanitize(text))


def may_be_container(text: str) -> Column:
    """Cheap test that every literal container passes."""
    return F.expr(
        f"coalesce({text} RLIKE r'{CONTAINER_HINT}' AND {text} RLIKE r\"{LITERAL_START}\", false)"
    )


@F.pandas_udf(T.BooleanType())
def _is_literal_container(text: pd.Series) -> pd.Series:
    def check(value):
        if value is None:
            return False
        try:
            return isinstance(ast.literal_eval(value), (tuple, list, dict, set))
        except Exception:
            return False

    return text.map(check).astype(bool)


def is_container_literal(text: str) -> Column:
    """True where text reads as a Python tuple, list, dict or set literal.

    Only hinted text is handed to Python; the rest travels as null.
    """
    return _is_literal_container(F.when(may_be_container(text), F.expr(text)))


def _needs_cleaning(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_needs_cleaning(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _needs_cleaning(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _needs_cleaning(dtype.valueType)
    return isinstance(
        dtype,
        (T.StringType, T.DoubleType, T.FloatType, T.TimestampType, T.TimestampNTZType),
    )


def clean_sql(value: str, dtype: T.DataType, text: bool = True, depth: int = 0) -> str:
    """SQL that cleans a value of any type, down to the leaves of structs, arrays and map values.

    NaN and the infinities become null and instants become ISO text; with ``text``, strings are sanitised.
    """
    if not _needs_cleaning(dtype):
        return value
    if isinstance(dtype, T.StringType):
        return _sanitize(value) if text else value
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return f"CASE WHEN abs({value}) < double('Infinity') THEN {value} END"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return _iso(value)
    if isinstance(dtype, T.ArrayType):
        x = f"x{depth}"
        return f"transform({value}, {x} -> {clean_sql(x, dtype.elementType, text, depth + 1)})"
    if isinstance(dtype, T.MapType):
        k, v = f"k{depth}", f"v{depth}"
        cleaned = clean_sql(v, dtype.valueType, text, depth + 1)
        return f"transform_values({value}, ({k}, {v}) -> {cleaned})"
    fields = ", ".join(
        f"{clean_sql(f'{value}.{quoted(f.name)}', f.dataType, text, depth)} AS {quoted(f.name)}"
        for f in dtype.fields
    )
    return f"CASE WHEN {value} IS NOT NULL THEN struct({fields}) END"


def text_leaves_sql(value: str, dtype: T.DataType, depth: int = 0) -> str | None:
    """SQL for all string leaves of a value as one array; None where its type holds none."""
    if isinstance(dtype, T.StringType):
        return f"array({value})"
    if isinstance(dtype, T.ArrayType):
        x = f"x{depth}"
        inner = text_leaves_sql(x, dtype.elementType, depth + 1)
        return inner and f"flatten(transform({value}, {x} -> {inner}))"
    if isinstance(dtype, T.MapType):
        return text_leaves_sql(f"map_values({value})", T.ArrayType(dtype.valueType), depth)
    if isinstance(dtype, T.StructType):
        parts = [
            text_leaves_sql(f"{value}.{quoted(f.name)}", f.dataType, depth) for f in dtype.fields
        ]
        filled = [f"coalesce({p}, cast(array() AS array<string>))" for p in parts if p]
        return f"concat({', '.join(filled)})" if filled else None
    return None


def sanitize_record(df: DataFrame) -> DataFrame:
    """Sanitise every column, key columns included, in one projection."""
    return df.selectExpr(
        *[
            f"{clean_sql(quoted(f.name), f.dataType)} AS {quoted(f.name)}"
            for f in df.schema.fields
        ]
    )
