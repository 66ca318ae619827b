"""Projections: field mapping, external ids, column sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmweave.functions.text import named

# Connector columns that must never be written back.
HUBSPOT_CONTACT_READ_ONLY = [
    "hs_email_optout",
    "createdate",
    "notes_last_updated",
    "hs_last_sales_activity_timestamp",
    "notes_last_contacted",
    "hs_latest_source_timestamp",
    "hs_email_last_click_date",
    "crmListMembershipDetails",
    "updatedAt",
    "pendingCriticalFieldsForCrmSync",
    "globalUnsubscribe",
]
HUBSPOT_COMPANY_READ_ONLY = [
    "createdate",
    "hs_lastmodifieddate",
    "hs_object_id",
    "updatedAt",
    "pendingCriticalFieldsForCrmSync",
]
MARKETO_LEAD_READ_ONLY = [
    "createdAt",
    "updatedAt",
    "isAnonymous",
    "inferredCompany",
    "inferredCountry",
    "inferredCity",
    "inferredMetropolitanArea",
    "inferredPhoneAreaCode",
    "inferredPostalCode",
    "inferredStateRegion",
    "anonymousIP",
]
UNSUBSCRIBE_COLUMNS = [
    "globalUnsubscribe",
    "pendingCriticalFieldsForCrmSync",
    "rejectionReason",
    "email",
]
# The mapping every stream has, unless it maps the field itself.
REMOTE_ID_FIELD = {"remote_id": "Id"}

EXTERNAL_ID = "externalId"


def mapped_sources(columns: list[str], fields: dict[str, str]) -> dict[str, str]:
    """For each target of a mapping that exists, in mapping order, the input column behind it.

    Sources are copied in input column order, and a copy sees the ones before it: where a
    target is itself a later source, the copied value moves on.
    """
    fields = fields if "remote_id" in fields else fields | REMOTE_ID_FIELD
    origin = {name: name for name in columns}
    for source in columns:
        if source in fields:
            origin[fields[source]] = origin[source]
    return {t: origin[t] for t in dict.fromkeys(fields.values()) if t in origin}


def map_fields(df: DataFrame, fields: dict[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Rename by ``{source: target}`` and expose the unmapped ``id`` as ``externalId``.

    The copies are worked out on names, so the plan holds one projection. The output has the
    targets that exist, in mapping order, then ``externalId``, then the ``keep`` columns.
    """
    sources = mapped_sources(df.columns, fields)
    if "id" in df.columns:
        sources[EXTERNAL_ID] = "id"
    return df.select(*[named(s).alias(t) for t, s in sources.items()], *[named(k) for k in keep])


def map_stream(
    df: DataFrame, stream: str, mapping: dict[str, dict[str, str]], keep: tuple[str, ...] = ()
) -> DataFrame:
    """``map_fields`` with the stream's entry of a mapping; a missing entry is an error."""
    if not mapping or stream not in mapping:
        raise ValueError(f"no field mapping for stream {stream!r}")
    return map_fields(df, mapping[stream], keep)


def external_id_guard(df: DataFrame) -> DataFrame:
    """Make sure ``externalId`` exists: from ``id``, else null."""
    if EXTERNAL_ID in df.columns:
        return df
    source = named("id") if "id" in df.columns else F.lit(None).cast("string")
    return df.withColumn(EXTERNAL_ID, source)


def drop_read_only(df: DataFrame, names: list[str]) -> DataFrame:
    """Remove read-only columns; absent names are ignored."""
    return df.drop(*names)


def ensure_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Add typed null columns that are missing."""
    missing = {n: F.lit(None).cast(t) for n, t in types.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


def rename_id_map(id_map: DataFrame, input_name: str, remote_name: str) -> DataFrame:
    """Name the two sides of an id map."""
    return id_map.withColumnsRenamed({"InputId": input_name, "RemoteId": remote_name})


def prune_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Keep only the named columns that exist, in the given order."""
    return df.select(*[named(n) for n in names if n in df.columns])


# The output columns of a mapped stream are chosen by the same rule.
select_output = prune_columns
