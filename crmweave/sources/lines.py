"""Where a row stood in its files, so that "the last row wins" can be said."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LINE = "__line"


def parquet_line() -> Column:
    """Position of a row of parquet files: the file, then the row in it."""
    return F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index").alias("row"))


def text_line() -> Column:
    """Position of a row of text files: blocks of a file are read whole and in order."""
    return F.struct(
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id().alias("row"),
    )
