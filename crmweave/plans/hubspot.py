"""HubSpot: contacts, companies, unsubscribe requests, and the way back."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmweave.functions.cleaning import sanitize_record
from crmweave.functions.text import is_blank, named, unsubscribe_path
from crmweave.operators.accounts import resolve_company_account
from crmweave.operators.dedupe import drop_sent
from crmweave.operators.enrich import (
    DETAILS,
    INLINE_LIST_BYTES,
    MEMBERSHIPS,
    OWNER_COLUMNS,
    account_lookup,
    enrich_list_memberships,
    enrich_owner,
    list_lookup,
    owner_lookup,
)
from crmweave.operators.envelope import wrap_envelope
from crmweave.operators.filters import approval_gate, drop_archived, is_flagged
from crmweave.operators.lookup import fits_broadcast, join_combined
from crmweave.operators.mapping import (
    HUBSPOT_COMPANY_READ_ONLY,
    HUBSPOT_CONTACT_READ_ONLY,
    UNSUBSCRIBE_COLUMNS,
    drop_read_only,
    ensure_columns,
    prune_columns,
)
from crmweave.operators.reports import approval_metrics, coverage_metrics, removed_metrics
from crmweave.plans.common import write_if_new_or_changed
from crmweave.plans.counts import Watch, unwatched
from crmweave.plans.result import WriteResult
from crmweave.session import Materialise, stay_lazy

SOURCE = "HUBSPOT"
OWNER_COLUMN = "hubspot_owner_id"
UNSUBSCRIBE_FLAG = "globalUnsubscribe"
READ_STREAMS = {"contacts": "email", "companies": "domain"}

# Columns the enrichment expects, with the type of their null stand-in.
EXPECTED = {
    "contacts": {OWNER_COLUMN: "string", "associatedcompanyid": "string", MEMBERSHIPS: "string"},
    "companies": {OWNER_COLUMN: "string", "is_public": "string", MEMBERSHIPS: "string"},
}


def contacts_write(
    contacts: DataFrame,
    sent: DataFrame | None,
    changed: DataFrame | None = None,
    materialise: Materialise = stay_lazy,
) -> DataFrame:
    """Contacts not sent yet, without read-only columns.

    Contacts are sent once; ``changed`` ids, if given, are sent again.
    """
    writable = drop_read_only(contacts, HUBSPOT_CONTACT_READ_ONLY)
    return sanitize_record(drop_sent(writable, sent, changed, materialise))


def accounts_write(
    accounts: DataFrame,
    stream_names: dict[str, str],
    sent: DataFrame | None,
    stored: DataFrame | None,
    materialise: Materialise = stay_lazy,
) -> WriteResult:
    """New and changed accounts; nothing unless ``stream_names`` maps ``accounts``."""
    if "accounts" not in stream_names:
        return WriteResult()
    writable = drop_read_only(accounts, HUBSPOT_COMPANY_READ_ONLY)
    return write_if_new_or_changed(writable, stream_names["accounts"], sent, stored, materialise)


def unsubscribe_requests(contacts: DataFrame, watch: Watch = unwatched) -> DataFrame:
    """One request ``path`` per contact that asked out, is approved and has an email.

    ``watch`` counts those who asked and wait for approval or were rejected.
    """
    needed = prune_columns(contacts, UNSUBSCRIBE_COLUMNS)
    empty = contacts.sparkSession.createDataFrame([], "email string, path string")
    if UNSUBSCRIBE_FLAG not in needed.columns or "email" not in needed.columns:
        return empty
    asked = needed.where(is_flagged(needed, UNSUBSCRIBE_FLAG))
    asked = watch(asked, UNSUBSCRIBE_FLAG, approval_metrics(asked, UNSUBSCRIBE_FLAG))
    allowed = approval_gate(asked, UNSUBSCRIBE_FLAG)
    return allowed.where(~is_blank(named("email"))).select(
        F.col("email"), unsubscribe_path(named("email")).alias("path")
    )


@dataclass
class Lookups:
    """The lookup tables of a read, prepared once and shared by its streams."""

    owners: DataFrame | None = None
    lists: DataFrame | None = None
    companies: DataFrame | None = None


def prepare_lookups(
    owners: DataFrame | None = None,
    lists: DataFrame | None = None,
    accounts: DataFrame | None = None,
    materialise: Materialise = stay_lazy,
) -> Lookups:
    """From the owner and list streams and the company id map.

    Each may be absent; one that lacks its columns counts as absent. With ``materialise`` each
    is reduced to one row per key once, for all streams of the read.
    """
    return Lookups(
        materialise(owner_lookup(owners), "owners") if _has(owners, "id") else None,
        materialise(list_lookup(lists), "lists") if _has(lists, "listId", "name") else None,
        materialise(account_lookup(accounts), "accounts")
        if _has(accounts, "InputId", "RemoteId")
        else None,
    )


def _has(df: DataFrame | None, *names: str) -> bool:
    return df is not None and set(names) <= set(df.columns)


def enrich_read(
    stream: DataFrame, name: str, lookups: Lookups, watch: Watch = unwatched
) -> DataFrame:
    """Live rows of a read stream with account, owner and list columns.

    Small lookups are joined where the rows are. Where several are large, they are resolved
    per combination of their keys first, so that the rows are shuffled once for all of them.
    ``watch`` counts the rows and those that are removed, and what the others were given.
    """
    owner_column = OWNER_COLUMN if OWNER_COLUMN in stream.columns else None
    base = ensure_columns(drop_archived(stream), EXPECTED[name])
    steps: list[_Step] = []
    if name == "contacts":
        steps.append(_Step(
            "associatedcompanyid", lookups.companies, ["accountId"],
            lambda df, keys: resolve_company_account(df, lookups.companies, keys),
        ))
    steps.append(_Step(
        owner_column, lookups.owners, OWNER_COLUMNS,
        lambda df, keys: enrich_owner(df, lookups.owners, owner_column, keys),
    ))
    steps.append(_Step(
        MEMBERSHIPS, lookups.lists, [DETAILS],
        lambda df, keys: enrich_list_memberships(df, lookups.lists, keys), INLINE_LIST_BYTES,
    ))
    together = [s for s in steps if s.shuffles()]
    # Keys are taken from ``base``, so that what is watched passes once.
    live = base
    if {"id", READ_STREAMS[name]} <= set(stream.columns):
        removed = removed_metrics(stream, "archived", READ_STREAMS[name])
        watched = watch(stream, name, removed, bool(together))
        live = ensure_columns(drop_archived(watched), EXPECTED[name])
    if len(together) < 2:
        for step in steps:
            live = step.apply(live, base)
        return live

    def resolve(keys: DataFrame) -> DataFrame:
        resolved = keys
        for step in together:
            resolved = step.apply(resolved, keys)
        return resolved

    columns = [s.column for s in together]
    live = join_combined(live, columns, resolve, keys_from=base).drop(*columns)
    for step in steps:
        if step not in together:
            live = step.apply(live, base)
    # As the steps one by one would have it.
    added = [c for s in steps for c in s.added if c in live.columns]
    return live.select(*[named(c) for c in live.columns if c not in added], *map(named, added))


@dataclass(eq=False)
class _Step:
    """One enrichment: its key column and lookup, the columns it adds, and how."""

    column: str | None
    lookup: DataFrame | None
    added: list[str]
    apply: Callable[[DataFrame, DataFrame], DataFrame]
    limit: int | None = None

    def shuffles(self) -> bool:
        """Whether the lookup is too large to be joined without a shuffle of the rows."""
        if self.column is None or self.lookup is None:
            return False
        return not fits_broadcast(self.lookup, self.limit)


def read_stream(
    stream: DataFrame, name: str, lookups: Lookups, watch: Watch = unwatched
) -> DataFrame:
    """Contacts or companies as envelopes."""
    enriched = enrich_read(stream, name, lookups, watch)
    if {"id", READ_STREAMS[name], "accountId"} <= set(enriched.columns):
        enriched = watch(enriched, f"{name}.enriched", coverage_metrics())
    return wrap_envelope(
        enriched,
        SOURCE,
        name,
        id_field="id",
        lookup_field=READ_STREAMS[name],
        on_missing="empty",
        sanitize=True,
        bool_strings=True,
    )


def output_name(stream: str, stream_names: dict[str, str]) -> str:
    """App stream of a connector stream; an unmapped one keeps its name."""
    return {connector: target for target, connector in stream_names.items()}.get(stream, stream)


def read(
    streams: dict[str, DataFrame],
    stream_names: dict[str, str],
    accounts: DataFrame | None,
    materialise: Materialise = stay_lazy,
    watch: Watch = unwatched,
) -> dict[str, DataFrame]:
    """Contacts and companies among the streams, enriched and wrapped, by output stream."""
    lookups = prepare_lookups(streams.get("owners"), streams.get("lists"), accounts, materialise)
    return {
        output_name(name, stream_names): read_stream(streams[name], name, lookups, watch)
        for name in READ_STREAMS
        if name in streams
    }
