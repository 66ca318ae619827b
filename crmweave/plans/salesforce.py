"""Salesforce: accounts, people split into Contact and Lead, and the way back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmweave.functions.cleaning import sanitize_record
from crmweave.functions.text import company_from_email, domain_from_website, named
from crmweave.operators.accounts import (
    CONTACT,
    HELD,
    LEAD,
    REMOTE,
    ROUTE,
    attach_account_id,
    resolve_sf_account,
    route_contacts,
    select_contact_data,
)
from crmweave.operators.dedupe import carried_over, drop_sent, latest_per_key
from crmweave.operators.envelope import union_person_streams, wrap_envelope
from crmweave.operators.filters import drop_deleted
from crmweave.operators.lookup import fits_broadcast
from crmweave.operators.mapping import EXTERNAL_ID, map_stream, mapped_sources, select_output
from crmweave.operators.nesting import nest_columns
from crmweave.operators.reports import held_back_metrics, removed_metrics, split_metrics
from crmweave.plans.common import write_if_new_or_changed
from crmweave.plans.counts import Watch, unwatched
from crmweave.plans.result import FieldMaps, WriteResult
from crmweave.session import Materialise, stay_lazy

ACCOUNT = "Account"
SOURCE = "SALESFORCE"


def accounts_write(
    accounts: DataFrame,
    mapping: FieldMaps,
    sent: DataFrame | None,
    stored: DataFrame | None,
    materialise: Materialise = stay_lazy,
) -> WriteResult:
    """App accounts to ``Account``; nothing without an ``Account`` mapping.

    ``mapping`` is keyed by connector object, ``sent`` is the id map, ``stored`` the content
    hashes of the last run.
    """
    if ACCOUNT not in mapping:
        return WriteResult()
    mapped = map_stream(accounts, ACCOUNT, mapping)
    return write_if_new_or_changed(mapped, ACCOUNT, sent, stored, materialise)


def contacts_write(
    contacts: DataFrame,
    mapping: FieldMaps,
    accounts: DataFrame | None,
    sent: dict[str, DataFrame] | None = None,
    snapshots: dict[str, DataFrame] | None = None,
    dynamic_contact_mapping: bool = False,
    order_by: str | None = None,
    unique_ids: bool = False,
    materialise: Materialise = stay_lazy,
    watch: Watch = unwatched,
) -> WriteResult:
    """App contacts to ``Contact`` and ``Lead``.

    ``accounts`` is the account id map; ``sent`` and ``snapshots`` hold the id map and the
    record snapshot of each object. A run emits the whole batch, and the rows of earlier
    batches that were never acknowledged. Of several rows with one id the last by
    ``order_by`` counts; ``unique_ids`` says there are none, so the batch is not shuffled.
    With ``materialise``, an object the batch has no rows for is left as it is, and ``watch``
    counts the rows of the batch by where they go.
    """
    if dynamic_contact_mapping:
        routed = route_contacts(contacts, accounts, keep_remote=True)
        routed = watch(routed, "contacts", split_metrics() + held_back_metrics())
        # Read and joined once for both objects, each of which then reads its own folder.
        routed = materialise(routed.where(F.col(ROUTE) != HELD), "contacts.routed", by=ROUTE)
    else:
        routed = contacts.withColumn(ROUTE, F.lit(CONTACT))
    result = WriteResult()
    for stream in (CONTACT, LEAD):
        if stream not in mapping or (stream == LEAD and not dynamic_contact_mapping):
            continue
        people = select_contact_data("salesforce", stream, routed)
        sources = mapped_sources([c for c in people.columns if c != REMOTE], mapping[stream])
        # Where AccountId is the routed account, the routing join has already found its CRM id.
        linked = stream == CONTACT and REMOTE in people.columns and (
            sources.get("AccountId") == "accountId"
        )
        keep = ([order_by] if order_by else []) + ([REMOTE] if linked else [])
        mapped = map_stream(people, stream, mapping, tuple(keep))
        batch = mapped.drop(order_by or "") if unique_ids else (
            latest_per_key(mapped, EXTERNAL_ID, order_by, materialise)
        )
        batch = materialise(batch, f"{stream}.batch")
        if materialise is not stay_lazy and batch.isEmpty():
            continue
        rows = batch.drop(REMOTE)
        if linked:
            pending = batch.withColumn("AccountId", F.col(REMOTE)).drop(REMOTE)
        else:
            pending = attach_account_id(rows, accounts) if stream == CONTACT else rows
        merged = rows
        old = (snapshots or {}).get(stream)
        if old is not None:
            # The batch counts as changed, so only rows carried over can be dropped as sent.
            # A lazy plan takes the batch's ids before its rows are reduced to one per id.
            # Stored rows have one id each, so only their accounts can be hot.
            carried = carried_over(old, mapped if materialise is stay_lazy else batch)
            carried = materialise(carried, f"{stream}.carried")
            unsent = drop_sent(
                carried, (sent or {}).get(stream), materialise=materialise, unique=True
            )
            if stream == CONTACT:
                unsent = attach_account_id(unsent, accounts, keys_from=old)
            merged = carried.unionByName(rows, allowMissingColumns=True)
            pending = unsent.unionByName(pending, allowMissingColumns=True)
        out = select_output(pending, rows.columns)
        if stream == LEAD and "Email" in out.columns:
            out = out.withColumn("Company", company_from_email(named("Email")))
        result.records[stream] = sanitize_record(out)
        result.state[stream] = merged
        result.changes[stream] = rows
    return result


def add_domain(accounts: DataFrame) -> DataFrame:
    """Add the ``domain`` of ``Website``, which account matching depends on."""
    if "Website" not in accounts.columns:
        raise ValueError("Website column is required to derive the account domain")
    return accounts.withColumn("domain", domain_from_website(named("Website").cast("string")))


def read_stream(
    stream: DataFrame,
    target: str,
    accounts: DataFrame | None,
    name: str = "",
    watch: Watch = unwatched,
) -> DataFrame:
    """One Salesforce object, ``name``, as envelopes of an app stream.

    ``watch`` counts its rows and those that are left out.
    """
    is_account = target == "accounts"
    lookup_field = "domain" if is_account else "Email"
    if is_account:
        stream = add_domain(stream)
    if lookup_field in stream.columns:
        shuffled = not is_account and accounts is not None and not fits_broadcast(accounts)
        stream = watch(stream, name, removed_metrics(stream, "IsDeleted", lookup_field), shuffled)
    live = drop_deleted(stream)
    if not is_account:
        live = resolve_sf_account(live, accounts)
    return wrap_envelope(
        nest_columns(live), SOURCE, target, id_field="Id", lookup_field=lookup_field, sanitize=True
    )


def read(
    streams: dict[str, DataFrame],
    routes: dict[str, str],
    accounts: DataFrame | None,
    watch: Watch = unwatched,
) -> dict[str, DataFrame]:
    """Mapped objects as envelopes by app stream; ``routes`` maps object to app stream."""
    wrapped: dict[str, list[DataFrame]] = {}
    for name in sorted(streams):
        if name in routes:
            envelope = read_stream(streams[name], routes[name], accounts, name, watch)
            wrapped.setdefault(routes[name], []).append(envelope)
    return {target: union_person_streams(*parts) for target, parts in wrapped.items()}
