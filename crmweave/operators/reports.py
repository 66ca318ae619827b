"""Counts that a run reports, each as a small DataFrame from one pass.

The ``..._metrics`` are the counts as columns, for ``agg`` here and for runs that count while
they write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crmweave.functions.jsontext import quoted
from crmweave.functions.cleaning import (
    is_comma_number,
    is_container_literal,
    is_nonfinite,
    may_be_container,
    text_leaves_sql,
)
from crmweave.operators.accounts import CONTACT, HELD, ROUTE, route_contacts
from crmweave.operators.filters import approval_state, has_lookup_key, is_flagged


def split_metrics() -> list[Column]:
    """For rows routed to contacts and leads."""
    linked = F.col(ROUTE) == CONTACT
    return [
        F.count("*").alias("total"),
        F.count_if(linked).alias("contacts"),
        F.count_if(~linked).alias("leads"),
    ]


def held_back_metrics() -> list[Column]:
    """For rows routed to contacts and leads."""
    return [F.count_if(F.col(ROUTE) == HELD).alias("held_back")]


def removed_metrics(df: DataFrame, flag: str, lookup_field: str) -> list[Column]:
    flagged = is_flagged(df, flag)
    return [
        F.count("*").alias("total"),
        F.count_if(flagged).alias("flagged"),
        F.count_if(~flagged & ~has_lookup_key(lookup_field)).alias("without_lookup_key"),
    ]


def approval_metrics(df: DataFrame, field: str) -> list[Column]:
    pending_ok, rejected_ok = approval_state(df, field)
    return [
        F.count_if(~pending_ok).alias("pending"),
        F.count_if(~rejected_ok).alias("rejected"),
        F.count_if(~(pending_ok & rejected_ok)).alias("skipped"),
    ]


def coverage_metrics() -> list[Column]:
    """For rows with account and list columns."""
    return [
        F.count("*").alias("total"),
        F.count("accountId").alias("with_account"),
        F.count("crmListMembershipDetails").alias("with_memberships"),
    ]


def split_counts(contacts: DataFrame, id_map: DataFrame | None) -> DataFrame:
    """Contacts in all, linked to an account, and not linked."""
    return route_contacts(contacts, id_map).agg(*split_metrics())


def held_back_count(contacts: DataFrame, id_map: DataFrame | None) -> DataFrame:
    """Contacts that wait for their account."""
    return route_contacts(contacts, id_map).agg(*held_back_metrics())


def removed_counts(df: DataFrame, flag: str, lookup_field: str) -> DataFrame:
    """Rows a read removes: flagged ones first, then those without a lookup value."""
    return df.agg(*removed_metrics(df, flag, lookup_field))


def approval_counts(df: DataFrame, field: str) -> DataFrame:
    """Pending, rejected and skipped rows; a row can be both pending and rejected."""
    return df.agg(*approval_metrics(df, field))


def enrichment_coverage(df: DataFrame) -> DataFrame:
    """Rows with a resolved account and with list memberships."""
    return df.agg(*coverage_metrics())


_NO_ENTRIES = "cast(array() AS array<struct<column_name:string,value:string>>)"


def sanitize_report(df: DataFrame) -> DataFrame:
    """``(column_name, reason, n)`` for string values that are nulled, repaired or only flagged.

    Values are exploded within the scan's tasks and counted there; only suspicious text that
    the cheap tests cannot settle reaches Python.
    """
    found = []
    for field in df.schema.fields:
        leaves = text_leaves_sql(quoted(field.name), field.dataType)
        if leaves is not None:
            name = field.name.replace("'", "\\'")
            pairs = f"transform({leaves}, v -> struct('{name}' AS column_name, v AS value))"
            found.append(f"coalesce({pairs}, {_NO_ENTRIES})")
    entries = df.selectExpr(f"inline(concat({', '.join([*found, _NO_ENTRIES])}))")
    suspicious = entries.where(is_nonfinite("value") | may_be_container("value"))
    settled = F.when(is_nonfinite("value"), "nonfinite").when(
        is_comma_number("value"), "comma_number"
    )
    judged = suspicious.withColumn("reason", settled)
    unsettled = is_container_literal("CASE WHEN reason IS NULL THEN value END")
    flagged = F.when(unsettled, "flagged_container")
    judged = judged.withColumn("reason", F.coalesce("reason", flagged))
    return (
        judged.where(F.col("reason").isNotNull())
        .groupBy("column_name", "reason")
        .agg(F.count("*").alias("n"))
    )
