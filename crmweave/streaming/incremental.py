"""Reading staged parquet files incrementally and writing their lines batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from crmweave.sinks.singer import JsonColumns, write_singer
from crmweave.sources.streams import Schema


def stream_files(
    spark: SparkSession, input_dir: str, stream: str, schema: Schema, files_per_batch: int = 1000
) -> DataFrame:
    """A stream's parquet files, old and new, as a streaming frame."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", f"{{{stream}.parquet,{stream}-*.parquet}}")
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(input_dir)
    )


def write_available(
    source: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    stream: str,
    output_dir: str,
    checkpoint_dir: str,
    json_columns: JsonColumns | None = None,
) -> StreamingQuery:
    """Run ``transform`` over all files not handled yet, then stop.

    Every batch has its own directory and overwrites it when it is repeated, so a restart
    after a failure neither loses nor doubles lines. Each directory has its SCHEMA line.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write_singer(
            transform(batch),
            stream,
            f"{output_dir}/batch={batch_id:08d}",
            json_columns,
            mode="overwrite",
        )

    return (
        source.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
