"""Linking people to accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crmweave.functions.text import is_blank, named
from crmweave.operators.lookup import lookup_join, unique_lookup
from crmweave.operators.mapping import ensure_columns, rename_id_map
from crmweave.sources.lines import LINE

CONTACT, LEAD, HELD = "Contact", "Lead", "Held"
ROUTE = "__route"
REMOTE = "RemoteAccountId"


def synced_accounts(id_map: DataFrame) -> DataFrame:
    """Accounts the CRM has acknowledged, as ``(AccountId, RemoteAccountId)``."""
    return rename_id_map(id_map, "AccountId", REMOTE).where(F.col(REMOTE).isNotNull())


def _account_lookup(id_map: DataFrame) -> DataFrame:
    """One CRM id per account, the last by the map's lines where it has their order."""
    return unique_lookup(synced_accounts(id_map), "AccountId", [REMOTE], _line(id_map))


def _line(id_map: DataFrame) -> str | None:
    return LINE if LINE in id_map.columns else None


def route_contacts(
    contacts: DataFrame, id_map: DataFrame | None, keep_remote: bool = False
) -> DataFrame:
    """Mark every contact ``Contact``, ``Lead`` or ``Held`` in column ``__route``, in one join.

    Linked to a synced account: Contact. Named account that is not synced yet: Held.
    No account: Lead. ``keep_remote`` keeps the account's CRM id as ``RemoteAccountId``.
    """
    contacts = ensure_columns(contacts, {"accountId": "string"})
    if id_map is None:
        linked = contacts.withColumn(REMOTE, F.lit(None).cast("string"))
    else:
        linked = lookup_join(contacts, _account_lookup(id_map), "accountId", "AccountId")
    route = (
        F.when(F.col(REMOTE).isNotNull(), CONTACT)
        .when(is_blank(named("accountId")), LEAD)
        .otherwise(HELD)
    )
    routed = linked.withColumn(ROUTE, route)
    return routed if keep_remote else routed.drop(REMOTE)


def hold_back_pending(contacts: DataFrame, id_map: DataFrame | None) -> DataFrame:
    """Remove contacts whose account has not been synced yet."""
    return route_contacts(contacts, id_map).where(F.col(ROUTE) != HELD).drop(ROUTE)


def split_contact_lead(
    contacts: DataFrame, id_map: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    """(contacts, leads) by account link; a contact of an unknown account is a lead."""
    if "accountId" not in contacts.columns:
        raise ValueError("accountId column is required")
    routed = route_contacts(contacts, id_map)
    is_contact = F.col(ROUTE) == CONTACT
    return routed.where(is_contact).drop(ROUTE), routed.where(~is_contact).drop(ROUTE)


def select_contact_data(crm: str, stream: str, routed: DataFrame) -> DataFrame:
    """Rows of a routed frame that belong to an object of the CRM."""
    if crm == "salesforce":
        if stream not in (CONTACT, LEAD):
            raise ValueError(f"Salesforce has no person object {stream!r}")
        routed = routed.where(F.col(ROUTE) == stream)
    return routed.drop(ROUTE)


def attach_account_id(
    people: DataFrame, id_map: DataFrame | None, keys_from: DataFrame | None = None
) -> DataFrame:
    """App account id in ``AccountId`` becomes ``InputAccountId``, the CRM's id ``AccountId``.

    Unmatched rows are kept with a null ``AccountId``. While no account is synced, nothing
    changes.
    """
    if id_map is None or "AccountId" not in people.columns:
        return people
    lookup = _account_lookup(id_map).withColumnRenamed("AccountId", "__account")
    joined = lookup_join(people, lookup, "AccountId", "__account", keys_from=keys_from)
    none_synced = synced_accounts(id_map).limit(1).agg(F.count("*") == 0).scalar()
    names = [c for c in people.columns if c != "InputAccountId"]
    attached = [
        F.when(none_synced, named(c)).otherwise(F.col(REMOTE)).alias(c)
        if c == "AccountId"
        else named(c)
        for c in names
    ]
    return joined.select(*attached, named("AccountId").cast("string").alias("InputAccountId"))


def resolve_sf_account(df: DataFrame, id_map: DataFrame | None) -> DataFrame:
    """Add the app's ``accountId`` for the CRM's ``AccountId``, which stays."""
    if id_map is None or "AccountId" not in df.columns:
        return df
    sides = rename_id_map(id_map, "accountId", "salesforce_account_id")
    lookup = unique_lookup(sides, "salesforce_account_id", ["accountId"], _line(id_map))
    return lookup_join(df.drop("accountId"), lookup, "AccountId", "salesforce_account_id")


def resolve_company_account(
    df: DataFrame, lookup: DataFrame | None, keys_from: DataFrame | None = None
) -> DataFrame:
    """``associatedcompanyid`` becomes the app's ``accountId``; unknown companies give null."""
    rest = df.drop("accountId")
    if lookup is None or "associatedcompanyid" not in df.columns:
        resolved = rest.withColumn("accountId", F.lit(None).cast("string"))
    else:
        accounts = lookup.select(F.col("InputId"), F.col("RemoteId").alias("accountId"))
        resolved = lookup_join(
            rest, accounts, "associatedcompanyid", "InputId", keys_from=keys_from
        )
    return resolved.drop("associatedcompanyid")
