"""Owner, list and account lookups and the joins that use them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmweave.functions.text import id_as_text, list_ids_sql, named, owner_full_name
from crmweave.operators.filters import drop_archived
from crmweave.operators.lookup import fits_broadcast, lookup_join, unique_lookup
from crmweave.sources.lines import LINE

OWNER_COLUMNS = ["crmOwnerName", "crmOwnerEmail"]
MEMBERSHIPS = "_hg_list_memberships"
DETAILS = "crmListMembershipDetails"

# A list table up to this estimate, and of so many rows, is inlined as a constant; above
# either, ids are joined.
INLINE_LIST_BYTES, INLINE_LIST_ROWS = 1 << 20, 20_000
_BUCKETS = 1024


def _order(df: DataFrame, order_by: str | None) -> str | None:
    """The column that says which row is last; a source's line position where none is given."""
    return order_by or (LINE if LINE in df.columns else None)


def owner_lookup(owners: DataFrame, order_by: str | None = None) -> DataFrame:
    """Owners that are not archived, as ``(owner_key, crmOwnerName, crmOwnerEmail)``."""
    order_by = _order(owners, order_by)
    if "id" not in owners.columns:
        raise ValueError("id column is required in owners")
    active = drop_archived(owners)
    empty = F.lit(None).cast("string")
    first, last, email = (
        named(c).cast("string") if c in owners.columns else empty
        for c in ("firstName", "lastName", "email")
    )
    extra = [named(order_by)] if order_by else []
    named_owners = active.select(
        id_as_text(named("id")).alias("owner_key"),
        owner_full_name(first, last, email).alias("crmOwnerName"),
        email.alias("crmOwnerEmail"),
        *extra,
    )
    return unique_lookup(named_owners, "owner_key", OWNER_COLUMNS, order_by)


def list_lookup(lists: DataFrame, order_by: str | None = None) -> DataFrame:
    """``(listId, name)`` as text, both present; the last row wins."""
    order_by = _order(lists, order_by)
    extra = [named(order_by)] if order_by else []
    filled = lists.select(
        id_as_text(named("listId")).alias("listId"),
        named("name").cast("string").alias("name"),
        *extra,
    ).where((F.col("listId") != "") & (F.col("name") != ""))
    return unique_lookup(filled, "listId", ["name"], order_by)


def account_lookup(id_map: DataFrame, order_by: str | None = None) -> DataFrame:
    """``(InputId, RemoteId)`` as text, both present; the last row wins."""
    order_by = _order(id_map, order_by)
    extra = [named(order_by)] if order_by else []
    filled = id_map.select(
        id_as_text(named("InputId")).alias("InputId"),
        id_as_text(named("RemoteId")).alias("RemoteId"),
        *extra,
    ).where(F.col("RemoteId").isNotNull())
    return unique_lookup(filled, "InputId", ["RemoteId"], order_by)


def enrich_owner(
    df: DataFrame,
    lookup: DataFrame | None,
    owner_column: str | None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Owner id becomes owner name and email; without a lookup or column they are null."""
    if lookup is None or not owner_column or owner_column not in df.columns:
        missing = [c for c in OWNER_COLUMNS if c not in df.columns]
        return df.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else df
    joined = lookup_join(
        df.drop(*OWNER_COLUMNS), lookup, owner_column, "owner_key", keys_from=keys_from
    )
    return joined.drop(owner_column)


def enrich_list_memberships(
    df: DataFrame, lookup: DataFrame | None, keys_from: DataFrame | None = None
) -> DataFrame:
    """List ids become ``[{id, name}]`` in id order; an unknown id has the empty name."""
    if MEMBERSHIPS not in df.columns:
        return df.withColumn(DETAILS, F.lit(None).cast("array<struct<id:string,name:string>>"))
    field = df.schema[MEMBERSHIPS]
    ids = list_ids_sql(MEMBERSHIPS, isinstance(field.dataType, T.ArrayType))
    df = df.drop(DETAILS)
    if lookup is None:
        return df.withColumn(DETAILS, _details(ids, "''")).drop(MEMBERSHIPS)
    if _inlinable(lookup):
        names = df.withColumn("__names", _bucketed_names(lookup))
        details = _details(ids, f"coalesce(get(__names, {_bucket('i')})[i], '')")
        return names.withColumn(DETAILS, details).drop("__names", MEMBERSHIPS)
    return _join_list_names(df, ids, lookup, df if keys_from is None else keys_from).drop(MEMBERSHIPS)


def _inlinable(lookup: DataFrame) -> bool:
    """The estimate is of compressed files, so rows are counted too, as far as the limit."""
    if not fits_broadcast(lookup, INLINE_LIST_BYTES):
        return False
    return lookup.limit(INLINE_LIST_ROWS + 1).count() <= INLINE_LIST_ROWS


def _details(ids: str, name: str) -> Column:
    return F.expr(f"transform({ids}, i -> struct(i AS id, {name} AS name))")


def _bucket(list_id: str) -> str:
    return f"cast(pmod(xxhash64({list_id}), {_BUCKETS}) AS int)"


def _bucketed_names(lookup: DataFrame) -> Column:
    """The whole (size-checked) lookup as one constant: an array of small maps.

    A map is searched entry by entry, so ids are hashed to a bucket first.
    """
    buckets = lookup.groupBy(F.expr(f"{_bucket('listId')} AS b")).agg(
        F.expr("map_from_entries(collect_list(struct(listId, name))) AS names")
    )
    by_bucket = buckets.agg(F.expr("map_from_entries(collect_list(struct(b, names))) AS m"))
    return by_bucket.selectExpr(f"transform(sequence(0, {_BUCKETS - 1}), i -> m[i])").scalar()


def _join_list_names(
    df: DataFrame, ids: str, lookup: DataFrame, keys_from: DataFrame
) -> DataFrame:
    """Resolve every distinct membership value once, then join the answers back to the rows."""
    # Text of its own for every value: an array as text alone would let ['1, 2'] meet ['1', '2'].
    is_text = isinstance(df.schema[MEMBERSHIPS].dataType, T.StringType)
    text = F.col(MEMBERSHIPS) if is_text else F.to_json(MEMBERSHIPS)
    keyed = keys_from.withColumn("__on", text)
    distinct = keyed.where(f"{MEMBERSHIPS} IS NOT NULL").groupBy(F.col("__on").alias("__text")).agg(
        F.any_value(MEMBERSHIPS).alias(MEMBERSHIPS)
    )
    pairs = distinct.selectExpr("__text", f"posexplode({ids}) AS (pos, id)")
    resolved = (
        lookup_join(pairs, lookup, "id", "listId")
        .groupBy("__text")
        .agg(F.expr("sort_array(collect_list(struct(pos, id, coalesce(name, '') AS name))) AS s"))
        .selectExpr("__text", f"transform(s, x -> struct(x.id, x.name)) AS {DETAILS}")
    )
    facts = df.withColumn("__on", text)
    return lookup_join(facts, resolved, "__on", "__text", keys_from=keyed).drop("__on")
