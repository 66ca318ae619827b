"""Helpers the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Arrow batches handed to Python hold so many rows and bytes at most, so that a run of very
# long texts does not fill a worker.
ARROW_LIMITS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session set to small Arrow batches, which it stays after the query."""
    for name, value in ARROW_LIMITS.items():
        df.sparkSession.conf.set(name, value)
    return df


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, by exact name, whatever else the frame holds.

    Other columns may differ from a wanted one by case alone or bear any internal name;
    they are gone before an operator adds columns of its own.
    """
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"c{df.columns.index(n)}").alias(n) for n in names])


def documents(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, text)``; a null text counts as empty."""
    rows = pick(df, id_column, text_column).toDF("doc_id", "text")
    return rows.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def tasks(df: DataFrame) -> int:
    """The session's number of shuffle partitions, the measure of the cluster's width."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_hash(column: Column | str) -> Column:
    """128-bit content hash of a string, as 16 bytes."""
    return F.unhex(F.md5(column))


def with_slots(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Number the rows of each group from 0 without a gap, however large the group.

    A group is dealt over as many parts as there are shuffle partitions; rows are numbered
    within a part, and a part starts where the parts before it end. ``df`` is read twice, so
    it should be cheap or written. Rows equal in all of ``order`` may swap their numbers.
    """
    parted = df.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(tasks(df))))
    counts = parted.groupBy(group, "__part").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(group).alias("__group"),
        F.col("__part").alias("__at"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"),
    )
    within = Window.partitionBy(group, "__part").orderBy(*order)
    ranked = parted.withColumn("__rank", F.row_number().over(within) - 1)
    joined = ranked.join(
        starts, ranked[group].eqNullSafe(starts["__group"]) & (F.col("__part") == F.col("__at"))
    )
    slot = (F.col("__start") + F.col("__rank")).cast("long")
    return joined.select(*df.columns, slot.alias(name))
