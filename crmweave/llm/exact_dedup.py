"""Exact dedup: group by a 128-bit content hash, compare bytes, keep one row of each group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmweave.llm.common import documents, text_hash
from crmweave.session import write_table

# The characters [\x20\x09-\x0D] that do not count when texts are compared.
SPACES = " \t\n\x0b\x0c\r"


def without_spaces(text: Column) -> Column:
    return F.translate(text, SPACES, "")


def _classes(keyed: DataFrame) -> DataFrame:
    """One row per distinct ``(hash, norm)``: the row that stays, and how many there are.

    Grouping on the hash and the text itself compares bytes, so texts that merely share a hash
    come apart. Copies are combined before the shuffle. The best row (most code points, then
    smallest id) is one decimal, n * 2^64 - id, which hash aggregation can update in place.
    """
    n = F.when(F.col("doc_id").isNotNull(), F.col("n"))
    wide = F.lit(1 << 32).cast("decimal(20,0)")
    best = (n.cast("decimal(11,0)") * wide * wide.cast("decimal(11,0)")).cast("decimal(38,0)")
    best = best - F.col("doc_id").cast("decimal(20,0)")
    found = keyed.groupBy("hash", "norm").agg(
        F.count("*").alias("group_size"), F.max(n).alias("most"), F.max(best).alias("best")
    )
    most = (F.col("most").cast("decimal(11,0)") * wide * wide.cast("decimal(11,0)")).cast("decimal(38,0)")
    return found.withColumn("keep_id", (most - F.col("best")).cast("long")).drop("most", "best")


def duplicate_groups(docs: DataFrame, digest: Callable[[Column], Column] = text_hash) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for every row of ``docs``.

    Texts are equal when they are so without ``SPACES``. Null and empty texts form one group.
    A repeated row counts in ``group_size``; all copies of the row that stays say ``kept``.
    A row without an id never stays before one with an id; where no row has one, ``keep_id``
    is null and all say ``kept``. Only ``doc_id`` and ``text`` are read. ``digest`` is a
    parameter so that tests can make texts collide.
    """
    norm = without_spaces(F.col("text"))
    keyed = documents(docs).select(
        "doc_id", digest(norm).alias("hash"), norm.alias("norm"), F.length("text").alias("n")
    )
    classes = _classes(keyed).select(
        "hash", "keep_id", "group_size", F.sha2("norm", 256).alias("text_sha256")
    )
    classes = write_table(classes, "exact-classes")
    shared = classes.groupBy("hash").count().where("count > 1").select("hash")
    rows = keyed.select("doc_id", "hash")
    if shared.isEmpty():
        joined = rows.join(classes, "hash")
    else:
        shared = write_table(shared, "exact-collisions")
        alone = rows.join(shared, "hash", "left_anti").join(classes, "hash")
        clashing = keyed.join(shared, "hash", "left_semi")
        apart = _classes(clashing).withColumn("text_sha256", F.sha2("norm", 256))
        both = clashing.select("doc_id", "hash", "norm").join(apart, ["hash", "norm"]).drop("norm")
        joined = alone.unionByName(both)
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def keep_unique(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Of repeated rows with the id that stays, one is left; of a group without ids, one row.
    """
    kept = duplicate_groups(docs).where("kept").groupBy("doc_id", "text_sha256").count()
    kept = write_table(kept, "exact-kept")
    columns = docs.columns
    inner = [f"c{i}" for i in range(len(columns))]
    key, text = (F.col(inner[columns.index(c)]) for c in ("doc_id", "text"))
    sha = F.sha2(without_spaces(F.coalesce(text.cast("string"), F.lit(""))), 256)
    rows = docs.toDF(*inner).withColumns({"__id": key, "__sha": sha})
    same = F.col("__id").eqNullSafe(F.col("doc_id")) & (F.col("__sha") == F.col("text_sha256"))
    stay = rows.join(kept, same, "left_semi")
    if not kept.where("count > 1").isEmpty():
        stay = stay.dropDuplicates(["__id", "__sha"])
    return stay.select(*inner).toDF(*columns)
