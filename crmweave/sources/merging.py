"""Parquet files of one stream whose columns differ in type, read as one frame.

Files that agree are read together. A type lattice says what two types have in common, and each
group of files is cast to that while it is read.
"""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmweave.functions.text import named
from crmweave.jvm import glob_paths
from crmweave.sources.lines import LINE, parquet_line

# Spark's names for schemas that cannot be merged.
CONFLICTS = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")
# Whole numbers by width.
WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
MOST_DIGITS = 38
NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)

# Files, and the schema that all of them fit.
Group = tuple[T.StructType, list[str]]


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that both fit: numbers widen, else text.

    Structs and arrays go by their parts; a date and a time stamp are a time stamp. Whole
    numbers beside floating ones become doubles, as does a decimal; beside other whole
    numbers a decimal keeps its scale.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.index)
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        decimals = [t for t in (a, b) if isinstance(t, T.DecimalType)]
        if decimals and all(t in decimals or t in WHOLE for t in (a, b)):
            scale = max(t.scale for t in decimals)
            whole = max(t.precision - t.scale if t in decimals else 19 for t in (a, b))
            if whole + scale <= MOST_DIGITS:
                return T.DecimalType(whole + scale, scale)
        return T.DoubleType()
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    return T.StringType()


def common_schema(a: T.StructType, b: T.StructType) -> T.StructType:
    """Fields of both, in order of first appearance, each of the common type."""
    kinds = {f.name: f.dataType for f in a}
    for f in b:
        kinds[f.name] = common_type(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in kinds.items()])


def conform(column: Column, kind: T.DataType, wanted: T.DataType) -> Column:
    """``column``, of type ``kind``, as ``wanted``; nested values that become text are JSON."""
    if kind == wanted:
        return column
    if isinstance(kind, T.StructType) and isinstance(wanted, T.StructType):
        held = {f.name: f.dataType for f in kind}
        fields = [
            (conform(column[f.name], held[f.name], f.dataType) if f.name in held else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in wanted
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(column, lambda x: conform(x, kind.elementType, wanted.elementType))
    if isinstance(wanted, T.StringType) and isinstance(kind, NESTED):
        return F.to_json(column)
    return column.cast(wanted)


def _merged(spark: SparkSession, paths: list[str]) -> T.StructType | None:
    """Schema of files that agree in their types, else None."""
    try:
        return spark.read.option("mergeSchema", True).parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as error:
        if not any(c in str(error) for c in CONFLICTS):
            raise
        return None


def _agree(a: T.StructType, b: T.StructType) -> bool:
    kinds = {f.name: f.dataType for f in a}
    return all(kinds.get(f.name, f.dataType) == f.dataType for f in b)


def schema_groups(spark: SparkSession, paths: list[str]) -> list[Group]:
    """The files in groups that agree in their types.

    Halves of the files are merged, by Spark's own distributed reading of footers, until they
    agree; then groups that agree with each other are put together. Few changes of type cost
    few such steps, however many files there are.
    """
    schema = _merged(spark, paths)
    if schema is not None:
        return [(schema, paths)]
    if len(paths) == 1:
        inside = glob_paths(spark, f"{paths[0]}/[!._]*")
        if not inside:
            raise ValueError(f"{paths[0]} disagrees with itself")
        return schema_groups(spark, inside)
    middle = len(paths) // 2
    groups: list[Group] = []
    for schema, files in schema_groups(spark, paths[:middle]) + schema_groups(spark, paths[middle:]):
        at = next((i for i, (held, _) in enumerate(groups) if _agree(held, schema)), None)
        if at is None:
            groups.append((schema, files))
        else:
            groups[at] = (common_schema(groups[at][0], schema), groups[at][1] + files)
    return groups


def read_parquet(spark: SparkSession, globs: list[str], with_line: bool = False) -> DataFrame:
    """Parquet files as one frame with the columns of all, whether or not their types agree."""
    schema = _merged(spark, globs)
    groups = [(schema, globs)]
    if schema is None:
        groups = schema_groups(spark, sorted({p for g in globs for p in glob_paths(spark, g)}))
    whole = reduce(common_schema, [s for s, _ in groups])
    parts = []
    for own, files in groups:
        kinds = {f.name: f.dataType for f in own}
        rows = spark.read.schema(own).parquet(*files)
        columns = [
            (conform(named(f.name), kinds[f.name], f.dataType) if f.name in kinds else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            if kinds.get(f.name) != f.dataType
            else named(f.name)
            for f in whole
        ]
        parts.append(rows.select(*columns, *([parquet_line().alias(LINE)] if with_line else [])))
    return reduce(DataFrame.unionAll, parts)
