"""Shards by jump consistent hashing (Lamping and Veach, 2014).

A key's shard follows from the key and the number of shards alone; no ring table is kept. When
shards are appended, a key either stays or moves into a new shard, and the share that moves is
the share of the new shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmweave.llm.common import documents, pick, with_slots

# The multiplier of the published method's generator, and its draw's width.
MULTIPLIER = np.uint64(2862933555777941757)
DRAW = float(1 << 31)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key; all keys take their jumps together."""
    if shards < 1:
        raise ValueError("there must be a shard")
    state = keys.astype(np.uint64)
    at = np.zeros(len(state), np.int64)
    left = np.arange(len(state))
    landed = np.zeros(len(state), np.int64)
    while left.size:
        at[left] = landed[left]
        with np.errstate(over="ignore"):
            state[left] = state[left] * MULTIPLIER + np.uint64(1)
        draw = (state[left] >> np.uint64(33)).astype(np.float64) + 1.0
        landed[left] = ((at[left] + 1) * (DRAW / draw)).astype(np.int64)
        left = left[landed[left] < shards]
    return at.astype(np.int32)


def shard_of(key: Column | str, shards: int) -> Column:
    """Shard of a key of any type; its 64-bit hash is what jumps. A null key has a shard too."""

    @F.pandas_udf("int")
    def jumped(hashes: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in hashes:
            yield pd.Series(jump(part.to_numpy(np.int64).view(np.uint64), shards))

    return jumped(F.xxhash64(key))


def assign_shards(df: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """``df`` with the shard of ``key`` as a new last column ``name``; nothing is shuffled.

    Rows with one key, repeated rows and null keys share a shard; an empty table stays empty.
    """
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    shard = shard_of(f"c{df.columns.index(key)}", shards)
    return numbered.select("*", shard.alias(name)).toDF(*df.columns, name)


def write_shards(df: DataFrame, key: str, shards: int, path: str) -> None:
    """Write one folder ``shard=N`` per shard that has rows; each task writes its part of each."""
    assign_shards(df, key, shards).write.partitionBy("shard").parquet(path)


def shard_manifest(docs: DataFrame, shards: int) -> DataFrame:
    """Per row: size, checksum, shard, place in the shard, and shard after one more is added.

    Size is the UTF-8 length of the text and 8 bytes for the id. A null text counts as empty,
    repeated rows have slots of their own, rows with a null id share one shard, other columns
    are not read. Law ``key``: id and shard count decide alone.
    """
    kept = documents(pick(docs, "doc_id", "text"))
    rows = kept.select(
        "doc_id",
        (F.octet_length("text") + 8).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of("doc_id", shards).alias("shard"),
        shard_of("doc_id", shards + 1).alias("grown_shard"),
    )
    placed = with_slots(rows, "shard", ["doc_id", "text_crc32", "size"], "slot")
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
