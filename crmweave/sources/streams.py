"""Staged streams: parquet files, or line-delimited JSON records."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmweave.functions.jsontext import is_json_sql
from crmweave.functions.text import strip
from crmweave.jvm import matches
from crmweave.session import scratch_path
from crmweave.sources.lines import LINE, parquet_line, text_line
from crmweave.sources.merging import read_parquet

logger = logging.getLogger(__name__)

# Extensions of record files; "" is a file named like the stream.
RECORD_EXTENSIONS = [".singer", ".json", ".jsonl", ""]
PARQUET_EXTENSION = ".parquet"

Schema = T.StructType | str

_MESSAGES = "array<struct<type:string,stream:string,record:string>>"
# Strict JSON, save the bare NaN and Infinity that JSON writers are known to emit.
_STRICT = {"allowSingleQuotes": "false"}


def stream_paths(
    spark: SparkSession, input_dir: str, stream: str, extensions: list[str]
) -> list[str]:
    """Globs of a stream that match files: the exact name, and names with a ``-`` suffix.

    The reader expands them, so the files of a stream are never listed through Python.
    """
    globs = [f"{input_dir}/{stream}{ext}" for ext in extensions]
    globs += [f"{input_dir}/{stream}-*{ext}" for ext in extensions if ext]
    return sorted(g for g in globs if matches(spark, g))


def scan_stream(
    spark: SparkSession,
    input_dir: str,
    stream: str,
    schema: Schema | None = None,
    with_line: bool = False,
    scratch: Callable[[str], str] | None = None,
) -> DataFrame:
    """All files of a stream as one frame; parquet wins over record files.

    Parquet files may differ in columns and in types (``merging``). Without a schema, the columns
    of record files are inferred from all their records, which are written once, under
    ``scratch(label)``, for that. ``with_line`` adds the position of each row, for "the last row
    wins". A stream without files gives no rows.
    """
    files = stream_paths(spark, input_dir, stream, [PARQUET_EXTENSION])
    if files:
        if schema is None:
            return read_parquet(spark, files, with_line)
        rows = spark.read.schema(schema).parquet(*files)
        return rows.withColumn(LINE, parquet_line()) if with_line else rows
    files = stream_paths(spark, input_dir, stream, RECORD_EXTENSIONS)
    if files:
        lines = spark.read.text(files)
        lines = lines.withColumn(LINE, text_line()) if with_line else lines
        records = parse_records(lines, stream, schema, keep=[LINE] if with_line else [])
        if schema is not None:
            return records
        path = scratch(stream) if scratch else scratch_path(spark, stream)
        return _inferred(records, path, with_line)
    logger.warning("no file for stream %r in %s", stream, input_dir)
    return spark.createDataFrame([], schema or T.StructType([]))


def _inferred(records: DataFrame, path: str, with_line: bool) -> DataFrame:
    """Records with the columns that all of them together have, by way of a written copy.

    With lines, a record is written beside its own.
    """
    spark = records.sparkSession
    if with_line:
        parts = F.lit('{"record":'), F.col("record"), F.lit(',"line":'), F.to_json(LINE), F.lit("}")
        records = records.select(F.concat(*parts))
    records.write.text(path)
    found = spark.read.options(**_STRICT).json(path)
    if not with_line:
        return found
    if "record" not in found.columns:
        return spark.createDataFrame([], T.StructType([]))
    return found.select("record.*", F.col("line").alias(LINE))


def read_typed(spark: SparkSession, input_dir: str, stream: str, schema: Schema) -> DataFrame:
    """A stream with declared types; columns a file lacks are null."""
    return scan_stream(spark, input_dir, stream, schema)


def parse_records(
    lines: DataFrame,
    stream: str,
    schema: Schema | None = None,
    column: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Records of one stream out of JSON lines.

    RECORD messages of this stream, or naming none, give their ``record`` (the whole message
    without one); SCHEMA and STATE messages, blank, malformed and non-object lines are
    skipped; any other object is itself a record. Columns in ``keep`` stay beside the record.
    """
    text = strip(F.col(column))
    messages = F.from_json(F.concat(F.lit("["), text, F.lit("]")), _MESSAGES, _STRICT)
    parsed = (
        lines.select(text.alias("text"), messages.alias("messages"), *keep)
        .where(f"startswith(text, '{{') AND {is_json_sql('text')} AND size(messages) = 1")
        .select("text", F.get("messages", F.lit(0)).alias("m"), *keep)
    )
    kind = F.coalesce(F.col("m.type"), F.lit(""))
    is_record = kind == "RECORD"
    ours = F.coalesce(F.col("m.stream"), F.lit(stream)) == stream
    payload = F.when(is_record, F.coalesce("m.record", "text")).otherwise(F.col("text"))
    records = parsed.where(~kind.isin("SCHEMA", "STATE") & (~is_record | ours)).select(
        payload.alias("record"), *keep
    )
    if schema is None:
        return records
    return records.select(F.from_json("record", schema).alias("r"), *keep).select("r.*", *keep)
