"""Joins against lookup tables that stay balanced when a key is hot or missing.

All joins of the library are left, semi or anti joins of a wide record table with a narrow
lookup. When Catalyst's size estimate lets the lookup be broadcast, a plain join is written
and nothing is shuffled. Otherwise the record side is prepared for the shuffle:

* the ``HOT_KEYS`` most frequent keys are found with ``approx_top_k`` (one narrow pass over
  the key column, bounded sketches, no shuffle of keys) and joined by broadcast;
* rows already joined, and rows without a key, take part in the shuffle join as rows that
  match nothing, under keys spread over ``SPREAD`` values, so they land evenly on all tasks.

The result does not depend on which keys the sketch reports: a key is only left out of the
shuffle join after the broadcast side has answered for it. What skew is left below those
keys is split by AQE's skew join, which the plain exchange under the join allows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmweave.functions.jsontext import quoted
from crmweave.functions.text import id_as_text, named
from crmweave.jvm import broadcast_threshold, estimated_bytes

HOT_KEYS = 1000
TRACKED_KEYS = 4096
SKETCH_GROUPS = 512
SPREAD = 1 << 20

_KEY = "__key"
_HOT = "__hot"
_HIT = "__hit"
_HOT_HIT = "__hot_hit"
_MEMBER = "__member"
_JOINABLE = "__joinable"
_COMBINED = "__combined"

_LARGE: ContextVar[bool] = ContextVar("large_lookups", default=False)


@contextmanager
def large_lookups() -> Iterator[None]:
    """Frames built inside take every lookup as too large to broadcast or inline."""
    token = _LARGE.set(True)
    try:
        yield
    finally:
        _LARGE.reset(token)


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """Whether the planner will take ``df`` for a broadcast under the session's threshold."""
    threshold = -1 if _LARGE.get() else broadcast_threshold(df.sparkSession)
    if threshold < 0:
        return False
    return estimated_bytes(df) <= (threshold if limit is None else min(threshold, limit))


def unique_lookup(
    df: DataFrame, key: str, values: list[str], order_by: str | None = None
) -> DataFrame:
    """One row per key: the last in ``order_by`` order, by default the largest values.

    ``max_by`` combines on the map side, so a key with many copies is reduced before the
    shuffle.
    """
    row = f"struct({', '.join(map(quoted, values))})"
    order = f"struct({quoted(order_by)}, {row})" if order_by else row
    return (
        df.where(f"{quoted(key)} IS NOT NULL")
        .groupBy(named(key))
        .agg(F.expr(f"max_by({row}, {order}) AS __last"))
        .selectExpr(quoted(key), *[f"__last.{quoted(v)} AS {quoted(v)}" for v in values])
    )


def _hot_keys(facts: DataFrame, key: Column) -> DataFrame:
    """The most frequent keys, at most ``HOT_KEYS``, from sketches merged in two steps."""
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("g")
    local = (
        facts.select(key.alias(_KEY), group)
        .where(F.col(_KEY).isNotNull())
        .groupBy("g")
        .agg(F.expr(f"approx_top_k({_KEY}, {HOT_KEYS}, {TRACKED_KEYS})").alias("top"))
    )
    return (
        local.select(F.inline("top").alias(_HOT, "n"))
        .groupBy(_HOT)
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), _HOT)
        .limit(HOT_KEYS)
        .select(_HOT)
    )


def _spread(facts: DataFrame, key: Column) -> DataFrame:
    """Add the key of the shuffle, and whether the row may match at all.

    The lookup's key goes into the shuffle as it is, so an exchange that reduced it to one row
    per key serves the join too. A filler key may equal a real one: such a row is not joinable.
    """
    filler = F.pmod(_row_hash(facts), F.lit(SPREAD)).cast("string")
    joinable = key.isNotNull() & F.col(_HOT).isNull()
    return facts.withColumns(
        {_KEY: F.when(joinable, key).otherwise(filler), _JOINABLE: F.coalesce(joinable, F.lit(False))}
    )


def _row_hash(facts: DataFrame) -> Column:
    # Map values cannot be hashed; the other columns tell rows apart well enough.
    plain = [named(f.name) for f in facts.schema.fields if "map<" not in f.dataType.simpleString()
             and "variant" not in f.dataType.simpleString()]
    return F.xxhash64(*plain) if plain else F.lit(0).cast("long")


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str,
    key: str,
    unique: bool = False,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Left join ``facts.on = lookup.key`` as text, adding the lookup's other columns.

    ``lookup`` must be unique on ``key``. A null key matches nothing. ``unique`` says that
    ``facts`` has one row per key too, so no key can be hot. ``keys_from`` is a frame with
    the same ``on`` column but a cheaper plan, for finding hot keys in a chain of joins.
    """
    values = [c for c in lookup.columns if c != key]
    lookup = lookup.selectExpr(f"cast({quoted(key)} AS string) AS {_MEMBER}", *map(quoted, values))
    fact_key = id_as_text(named(on))

    if unique or fits_broadcast(lookup):
        return facts.join(lookup, fact_key == F.col(_MEMBER), "left").drop(_MEMBER)

    kept = [quoted(c) for c in facts.columns]
    hit = F.struct(*[named(v) for v in values])
    hot_keys = _hot_keys(facts if keys_from is None else keys_from, fact_key)
    # At most HOT_KEYS rows. The sketch is referenced once, so "hot" and "has an answer" agree.
    hot = hot_keys.join(lookup, F.col(_HOT) == F.col(_MEMBER), "left").select(
        _HOT, F.when(F.col(_MEMBER).isNotNull(), hit).alias(_HOT_HIT)
    )
    facts = _spread(facts.join(F.broadcast(hot), fact_key == F.col(_HOT), "left"), fact_key)
    cold = lookup.where(F.col(_MEMBER).isNotNull()).select(_MEMBER, hit.alias(_HIT))
    joined = facts.join(cold, (F.col(_KEY) == F.col(_MEMBER)) & F.col(_JOINABLE), "left")
    answers = [
        f"coalesce({_HIT}, {_HOT_HIT}).{quoted(v)} AS {quoted(v)}" for v in values
    ]
    return joined.selectExpr(*kept, *answers)


def join_combined(
    facts: DataFrame,
    columns: list[str],
    resolve: Callable[[DataFrame], DataFrame],
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Answers to several large lookups, with one shuffle of ``facts``.

    ``resolve`` gets the distinct combinations of ``columns``, other types than arrays as text,
    and adds its answers to them, keeping the column that names the combination. It may drop
    ``columns``; the answers replace columns of ``facts`` of their names, and ``columns`` stay
    there. Only what is as narrow as the keys is shuffled once per lookup, and rows that share
    their keys are resolved once. ``keys_from`` as in ``lookup_join``.
    """
    fields = [facts.schema[c] for c in columns]
    arrays = {f.name for f in fields if isinstance(f.dataType, T.ArrayType)}
    parts = [named(c) if c in arrays else id_as_text(named(c)).alias(c) for c in columns]
    combined = F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})
    text = T.StringType()
    schema = T.StructType([f if f.name in arrays else T.StructField(f.name, text) for f in fields])

    narrow = (facts if keys_from is None else keys_from).select(combined.alias(_COMBINED))
    keys = narrow.distinct().select(_COMBINED, F.from_json(_COMBINED, schema).alias(_KEY))
    answers = resolve(keys.select(_COMBINED, f"{_KEY}.*")).drop(*columns)
    kept = facts.drop(*[c for c in answers.columns if c != _COMBINED])
    joined = lookup_join(
        kept.withColumn(_COMBINED, combined), answers.withColumnRenamed(_COMBINED, "__answered"),
        _COMBINED, "__answered", keys_from=narrow,
    )
    return joined.drop(_COMBINED)


def anti_join(
    facts: DataFrame,
    keys: DataFrame,
    on: str,
    key: str,
    unique: bool = False,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``facts`` whose key, as text, is not in ``keys``; null keys are kept.

    ``unique`` and ``keys_from`` as in ``lookup_join``; ``keys`` may repeat.
    """
    keys = keys.select(id_as_text(named(key)).alias(_MEMBER))
    fact_key = id_as_text(named(on))
    if unique or fits_broadcast(keys):
        return facts.join(keys, fact_key == F.col(_MEMBER), "left_anti")
    kept = [quoted(c) for c in facts.columns]
    hot_keys = _hot_keys(facts if keys_from is None else keys_from, fact_key)
    # At most HOT_KEYS rows, each with whether it is a member.
    hot = hot_keys.join(keys, F.col(_HOT) == F.col(_MEMBER), "left").groupBy(_HOT).agg(
        F.bool_or(F.col(_MEMBER).isNotNull()).alias(_HOT_HIT)
    )
    marked = facts.join(F.broadcast(hot), fact_key == F.col(_HOT), "left")
    left = _spread(marked.where(F.col(_HOT_HIT).isNull() | ~F.col(_HOT_HIT)), fact_key)
    joined = left.join(keys, (F.col(_KEY) == F.col(_MEMBER)) & F.col(_JOINABLE), "left_anti")
    return joined.selectExpr(*kept)
