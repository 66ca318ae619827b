"""Session settings the library relies on, and where it may keep scratch tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from crmweave.jvm import checkpoint_dir

# Writes an intermediate table, one folder per value of a column where one is named (``by``),
# and returns it as read back.
Materialise = Callable[..., DataFrame]

# CRM field names differ by case alone (``id``/``Id``, ``accountId``/``AccountId``),
# and every timestamp leaves in UTC.
SETTINGS = {
    "spark.sql.caseSensitive": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a running session."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a written intermediate table.

    On a cluster this lies in the shared folder named by ``spark.checkpoint.dir``, which must
    be set there; where all of Spark runs in one process, this machine's temporary folder will do.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    if not root and re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        root = os.path.join(tempfile.gettempdir(), "crmweave")
    if not root:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stay_lazy(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """The ``Materialise`` that writes nothing."""
    return df


def write_table(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write an intermediate table: lineage ends there, and its size is known from its files."""
    return write_and_read(df, scratch_path(df.sparkSession, label), by)


def write_and_read(df: DataFrame, path: str, by: str | None = None) -> DataFrame:
    """A frame as a table under a path; with ``by``, text, a filter on it picks folders."""
    if by is None:
        df.write.parquet(path)
        return df.sparkSession.read.parquet(path)
    df.write.partitionBy(by).parquet(path)
    # Without rows there are no files that would tell the columns.
    return df.sparkSession.read.schema(df.schema).parquet(path)
