"""Id maps that the CRM side writes after it has taken records in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crmweave.jvm import matches
from crmweave.sources.lines import LINE, text_line

# File name format and columns.
ID_MAP_SUFFIX = ".snapshot.csv"
ID_MAP_COLUMNS = ["InputId", "RemoteId"]


def read_id_map(
    spark: SparkSession,
    snapshot_dir: str,
    stream: str,
    flow: str,
    with_line: bool = False,
    malformed: str = "raise",
) -> DataFrame | None:
    """``(InputId, RemoteId)`` as text, or None where nothing was sent yet.

    ``with_line`` adds an orderable position, so that "the last row wins" can be said. A file
    without both columns raises, since taking it for "nothing sent" would send everything
    again; with ``malformed="absent"`` it counts as no map.
    """
    path = f"{snapshot_dir}/{stream}_{flow}{ID_MAP_SUFFIX}"
    if not matches(spark, path):
        return None
    table = spark.read.option("header", True).option("escape", '"').csv(path)
    if any(c not in table.columns for c in ID_MAP_COLUMNS):
        if malformed == "raise":
            raise ValueError(f"{path} lacks one of the columns {', '.join(ID_MAP_COLUMNS)}")
        return None
    if not with_line:
        return table.select(*ID_MAP_COLUMNS)
    return table.select(*ID_MAP_COLUMNS, text_line().alias(LINE))
