"""Incremental sending: what was sent, what changed, and the keyed state behind it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmweave.functions.jsontext import json_with_nulls, quoted
from crmweave.functions.text import id_as_text, named
from crmweave.operators.lookup import anti_join, fits_broadcast, lookup_join
from crmweave.operators.mapping import EXTERNAL_ID
from crmweave.session import Materialise, stay_lazy

HASH = "content_hash"


def drop_sent(
    df: DataFrame,
    sent: DataFrame | None,
    changed: DataFrame | None = None,
    materialise: Materialise = stay_lazy,
    unique: bool = False,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Keep rows whose ``externalId`` was never sent, or is in ``changed``.

    ``unique`` says that ``df`` has one row per id, ``keys_from`` is a frame with the same
    ``externalId`` and a cheaper plan.

    Ids that were sent and did not change are taken out of the id map first, so the wide
    rows go through one join. With ``materialise`` and an id map too large to broadcast, the
    ids that are due are found first: most runs send little of what they read, and then the
    wide rows meet a small broadcast table instead of being shuffled.
    """
    if sent is None:
        return df
    if EXTERNAL_ID not in df.columns:
        raise ValueError("externalId column is required")
    if "InputId" not in sent.columns:
        raise ValueError("InputId column is required in the id map")
    settled = sent.select("InputId")
    if changed is not None:
        settled = anti_join(settled, changed, "InputId", EXTERNAL_ID)
    if materialise is stay_lazy or fits_broadcast(settled):
        return anti_join(df, settled, EXTERNAL_ID, "InputId", unique, keys_from)
    ids = df.select(named(EXTERNAL_ID).cast("string").alias("__due")).where("__due IS NOT NULL")
    due = anti_join(ids.distinct(), settled, "__due", "InputId", unique=True)
    due = materialise(due, "due")
    is_due = due.withColumn("__is_due", F.lit(True))
    marked = lookup_join(df, is_due, EXTERNAL_ID, "__due", unique, keys_from)
    return marked.where(f"__is_due OR {EXTERNAL_ID} IS NULL").drop("__is_due")


def content_hash(df: DataFrame) -> Column:
    """Hash of a row's content, independent of column order."""
    return F.sha2(json_with_nulls([quoted(c) for c in sorted(df.columns)]), 256)


def detect_changed(df: DataFrame, stored: DataFrame | None, pk: str = EXTERNAL_ID) -> DataFrame:
    """``(pk, content_hash)`` of the ids that are new or differ from the stored hash.

    Only ids and hashes are shuffled. Copies of an id within the batch count as one, with
    the largest hash; they are combined on the map side.
    """
    current = (
        df.select(id_as_text(named(pk)).alias(pk), content_hash(df).alias(HASH))
        .groupBy(pk)
        .agg(F.max(HASH).alias(HASH))
    )
    if stored is None:
        return current
    previous = stored.select(named(pk).alias("__pk"), F.col(HASH).alias("__stored"))
    joined = lookup_join(current, previous, pk, "__pk", unique=True)
    return joined.where(~F.col(HASH).eqNullSafe(F.col("__stored"))).drop("__stored")


def latest_per_key(
    df: DataFrame, pk: str, order_by: str | None = None, materialise: Materialise = stay_lazy
) -> DataFrame:
    """One row per key: the last by ``order_by``, ties by content, without ``order_by``.

    All keyless rows stay. With ``materialise``, keys are counted first, on the key column
    alone, and only rows of repeated keys are compared; the others pass as they are.
    """
    kept = [quoted(c) for c in df.columns if c != order_by]
    keyed, keyless = df.where(named(pk).isNotNull()), df.where(named(pk).isNull())
    once = None
    if materialise is not stay_lazy:
        counts = keyed.groupBy(id_as_text(named(pk)).alias("__again")).count().where("count > 1")
        again = materialise(counts.select("__again"), "repeated")
        if fits_broadcast(again):
            once = anti_join(keyed, again, pk, "__again")
            keyed = keyed.join(F.broadcast(again), id_as_text(named(pk)) == F.col("__again"), "left_semi")
    content = content_hash(df)
    order = F.struct(named(order_by), content) if order_by else content
    row = F.expr(f"struct({', '.join(map(quoted, df.columns))})")
    picked = keyed.groupBy(named(pk).alias("__pk")).agg(F.max_by(row, order).alias("__row"))
    parts = [picked.selectExpr(*[f"__row.{c} AS {c}" for c in kept]), keyless.selectExpr(*kept)]
    if once is not None:
        parts.append(once.selectExpr(*kept))
    return reduce(DataFrame.unionAll, parts)


def upsert_snapshot(
    old: DataFrame | None,
    new: DataFrame,
    pk: str = EXTERNAL_ID,
    order_by: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Merge ``new`` into keyed state: the newest row of every key.

    ``unique`` says that ``new`` has one row per key already. A stored row without a key
    cannot be matched by later runs, so it is not carried over.
    """
    new = new if unique else latest_per_key(new, pk, order_by)
    if old is None:
        return new
    return carried_over(old, new, pk).unionByName(new, allowMissingColumns=True)


def carried_over(old: DataFrame, new: DataFrame, pk: str = EXTERNAL_ID) -> DataFrame:
    """Stored rows that the batch does not replace."""
    return anti_join(old.where(named(pk).isNotNull()), new, pk, pk, unique=True)
