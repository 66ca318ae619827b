"""Wrapping rows into the ``{data, sourceRecordId, source, lookupKey}`` envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmweave.functions.cleaning import clean_sql
from crmweave.functions.jsontext import json_with_bools, json_with_nulls, quoted
from crmweave.functions.text import id_as_text, named
from crmweave.operators.filters import require_lookup_key
from crmweave.operators.nesting import SPARSE

ENVELOPE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("data", "sourceRecordId", "source", "lookupKey")]
)
PERSON_STREAMS = ("contact", "lead")


def default_lookup_field(stream: str) -> str:
    """People are matched by email, everything else by domain."""
    return "email" if any(p in stream.lower() for p in PERSON_STREAMS) else "domain"


def default_id_field(df: DataFrame) -> str | None:
    return next((n for n in ("id", "Id") if n in df.columns), None)


def _cleaned(field: T.StructField, text: bool) -> str:
    value = clean_sql(quoted(field.name), field.dataType, text)
    if field.metadata == SPARSE and isinstance(field.dataType, (T.StructType, T.ArrayType)):
        value = f"parse_json(to_json({value}))"
    return f"{value} AS {quoted(field.name)}"


def wrap_envelope(
    df: DataFrame,
    source: str,
    stream: str = "",
    id_field: str | None = None,
    lookup_field: str | None = None,
    on_missing: str = "raise",
    sanitize: bool = False,
    bool_strings: bool = False,
) -> DataFrame:
    """Rows with a lookup value, wrapped; ``data`` is JSON text of all columns, nulls kept.

    A missing id or lookup column raises, gives no rows (``"empty"``) or leaves the rows as
    they are (``"passthrough"``). ``sanitize`` cleans the string leaves and the keys, after
    the lookup filter; ``bool_strings`` turns ``"true"``/``"false"`` leaves into booleans.
    """
    lookup_field = lookup_field or default_lookup_field(stream)
    id_field = id_field or default_id_field(df)
    missing = [n for n in (id_field, lookup_field) if n is None or n not in df.columns]
    if missing:
        if on_missing == "passthrough":
            return df
        if on_missing == "empty":
            return df.sparkSession.createDataFrame([], ENVELOPE)
        raise ValueError(f"cannot wrap {stream!r}: no column {missing[0] or 'id/Id'!r}")

    # Cleaned in a projection of its own: the JSON step uses each value more than once.
    cleaned = require_lookup_key(df, lookup_field).selectExpr(
        *[_cleaned(f, sanitize) for f in df.schema.fields]
    )
    if bool_strings:
        data = json_with_bools(cleaned.schema)
    else:
        data = json_with_nulls([quoted(c) for c in cleaned.columns])
    return cleaned.select(
        data.alias("data"),
        id_as_text(named(id_field)).alias("sourceRecordId"),
        F.lit(source).alias("source"),
        id_as_text(named(lookup_field)).alias("lookupKey"),
    )


def union_person_streams(*wrapped: DataFrame) -> DataFrame:
    """One stream of envelopes from several person streams."""
    result = wrapped[0]
    for other in wrapped[1:]:
        result = result.unionByName(other)
    return result
