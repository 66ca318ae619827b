"""Dedupe, state, account links and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from checks.views import Tables
from crmweave.operators import accounts, dedupe, enrich
from crmweave.operators.dedupe import HASH, content_hash
from crmweave.operators.mapping import EXTERNAL_ID
from crmweave.session import scratch_path
from crmweave.sinks.snapshots import SnapshotStore

SQL_HASH = "sha256(to_json({'annual_revenue': annual_revenue, 'externalId': \"externalId\", 'name': name})::VARCHAR)"


def _stored(t: Tables):
    previous = t.view("previous_accounts")
    return previous.select("externalId", content_hash(previous).alias(HASH))


def _batch(t: Tables):
    return t.view("crm_contacts").select(F.col("id").alias("externalId"), "last_name")


@check(
    "drop_sent",
    """SELECT id AS "externalId", last_name FROM crm_contacts
    WHERE id NOT IN (SELECT InputId FROM contact_id_map)""",
    large=True,
)
def sent(t: Tables):
    return dedupe.drop_sent(_batch(t), t.view("contact_id_map"))


@check(
    "drop_sent_keep_changed",
    """SELECT id AS "externalId", last_name FROM crm_contacts
    WHERE id NOT IN (SELECT InputId FROM contact_id_map)
    OR id IN (SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F')""",
    large=True,
)
def sent_or_changed(t: Tables):
    changed = t.table("orders").where("o_orderstatus = 'F'")
    changed = changed.select(F.col("o_custkey").cast("string").alias("externalId"))
    return dedupe.drop_sent(_batch(t), t.view("contact_id_map"), changed)


CHANGED_SQL = f"""SELECT c."externalId", c.h AS content_hash
    FROM (SELECT *, {SQL_HASH} AS h FROM current_accounts) c
    LEFT JOIN (SELECT *, {SQL_HASH} AS h FROM previous_accounts) p USING ("externalId")
    WHERE p.h IS NULL OR p.h <> c.h"""


@check("detect_changed", CHANGED_SQL)
def changed(t: Tables):
    return dedupe.detect_changed(t.view("current_accounts"), _stored(t))


UPSERT_SQL = """SELECT "externalId", priority FROM account_changes
    QUALIFY row_number() OVER (PARTITION BY "externalId" ORDER BY version DESC) = 1
    UNION ALL
    SELECT "externalId", priority FROM account_state
    WHERE "externalId" NOT IN (SELECT "externalId" FROM account_changes)"""


@check("detect_changed_pruned", CHANGED_SQL)
def changed_pruned(t: Tables):
    """State in a store, of which only the parts are read that the batch's ids can lie in."""
    store = SnapshotStore(t.spark, scratch_path(t.spark, "state"))
    store.commit({"accounts": store.upsert("accounts", _stored(t))})
    current = t.view("current_accounts")
    return dedupe.detect_changed(current, store.read("accounts", current))


@check("upsert_snapshot", UPSERT_SQL)
def upsert(t: Tables):
    return dedupe.upsert_snapshot(
        t.view("account_state"), t.view("account_changes"), order_by="version"
    )


@check("upsert_store", UPSERT_SQL)
def upsert_store(t: Tables):
    """The same through a store whose parts are split as the state grows."""
    store = SnapshotStore(t.spark, scratch_path(t.spark, "state"), part_bytes=1 << 10)
    store.commit({"accounts": store.upsert("accounts", t.view("account_state"))})
    changes = dedupe.latest_per_key(t.view("account_changes"), EXTERNAL_ID, "version")
    store.commit({"accounts": store.upsert("accounts", changes)})
    return store.read("accounts")


@check(
    "split_contact_lead",
    """SELECT id, CASE WHEN m.InputId IS NULL THEN 'Lead' ELSE 'Contact' END AS kind
    FROM crm_contacts c LEFT JOIN (SELECT * FROM account_id_map WHERE RemoteId IS NOT NULL) m
    ON m.InputId = c.account_id""",
    large=True,
)
def split(t: Tables):
    contacts, leads = accounts.split_contact_lead(t.app_contacts(), t.view("account_id_map"))
    return contacts.select("id", F.lit("Contact").alias("kind")).unionByName(
        leads.select("id", F.lit("Lead").alias("kind"))
    )


@check(
    "attach_account_id",
    """SELECT id, account_id AS "InputAccountId", m.RemoteId AS "AccountId"
    FROM crm_contacts c LEFT JOIN (SELECT * FROM account_id_map WHERE RemoteId IS NOT NULL) m
    ON m.InputId = c.account_id""",
)
def attach(t: Tables):
    people = t.view("crm_contacts").select("id", F.col("account_id").alias("AccountId"))
    return accounts.attach_account_id(people, t.view("account_id_map"))


@check(
    "resolve_sf_account",
    """WITH latest AS (SELECT RemoteId, max(InputId) AS app_id FROM repeated_id_map
      WHERE RemoteId IS NOT NULL GROUP BY RemoteId)
    SELECT id, 'A' || id AS crm_account, app_id AS account FROM crm_contacts c
    LEFT JOIN latest ON RemoteId = 'A' || id""",
    large=True,
)
def resolve_sf(t: Tables):
    people = t.view("crm_contacts").select("id", F.concat(F.lit("A"), "id").alias("AccountId"))
    resolved = accounts.resolve_sf_account(people, t.view("repeated_id_map").drop("line"))
    return resolved.withColumnsRenamed({"AccountId": "crm_account", "accountId": "account"})


@check(
    "resolve_company_account",
    """SELECT id, m.RemoteId AS "accountId" FROM crm_contacts c
    LEFT JOIN account_id_map m ON m.InputId = c.company_id""",
)
def resolve_company(t: Tables):
    contacts = t.hubspot_contacts().select("id", "associatedcompanyid")
    lookup = enrich.account_lookup(t.view("account_id_map"))
    return accounts.resolve_company_account(contacts, lookup)


SQL_OWNERS = """(SELECT id AS owner_key, coalesce(nullif(trim(trim(coalesce(first_name, '')) || ' ' ||
    trim(coalesce(last_name, ''))), ''), email) AS "crmOwnerName", email AS "crmOwnerEmail"
    FROM crm_owners WHERE NOT archived)"""


@check(
    "enrich_owner",
    f"""SELECT id, "crmOwnerName", "crmOwnerEmail" FROM crm_contacts
    LEFT JOIN {SQL_OWNERS} o ON owner_id = owner_key""",
    large=True,
)
def owner(t: Tables):
    contacts = t.hubspot_contacts().select("id", "hubspot_owner_id")
    return enrich.enrich_owner(contacts, enrich.owner_lookup(t.owners()), "hubspot_owner_id")


SQL_LIST_NAME = "(SELECT coalesce(max(name), '') FROM crm_lists l WHERE l.list_id = '{i}')"


def _sql_details(ids: list[str]) -> str:
    items = [
        "{'id': '%s', 'name': %s}" % (i, SQL_LIST_NAME.format(i=i)) for i in ids
    ]
    return f"to_json([{', '.join(items)}])::VARCHAR"


SQL_DETAILS = f"""(CASE list_memberships
    WHEN '[0, "3", null]' THEN {_sql_details(['0', '3'])}
    WHEN '1, 4,' THEN {_sql_details(['1', '4'])} WHEN '2' THEN {_sql_details(['2'])}
    WHEN '[9]' THEN {_sql_details(['9'])} WHEN '"1"' THEN {_sql_details(['"1"'])} END)"""


@check(
    "enrich_list_memberships", f"SELECT id, {SQL_DETAILS} AS details FROM crm_contacts", large=True
)
def memberships(t: Tables):
    contacts = t.hubspot_contacts().select("id", "_hg_list_memberships")
    enriched = enrich.enrich_list_memberships(contacts, enrich.list_lookup(t.lists()))
    return enriched.select("id", F.to_json("crmListMembershipDetails").alias("details"))


_ARRAYS = """CASE CAST(id AS INT) % 5 WHEN 0 THEN array('1, 2') WHEN 1 THEN array('1', '2')
    WHEN 2 THEN array(CAST(NULL AS STRING)) WHEN 3 THEN array('0', '9') END"""


@check(
    "enrich_list_memberships_arrays",
    f"""SELECT id, CASE CAST(id AS INT) % 5 WHEN 0 THEN {_sql_details(['1, 2'])}
    WHEN 1 THEN {_sql_details(['1', '2'])} WHEN 3 THEN {_sql_details(['0', '9'])} END AS details
    FROM crm_contacts""",
    large=True,
)
def array_memberships(t: Tables):
    contacts = t.view("crm_contacts").select("id", F.expr(_ARRAYS).alias("_hg_list_memberships"))
    enriched = enrich.enrich_list_memberships(contacts, enrich.list_lookup(t.lists()))
    return enriched.select("id", F.to_json("crmListMembershipDetails").alias("details"))


@check(
    "select_contact_data",
    """SELECT id, email FROM crm_contacts c WHERE account_id IN
    (SELECT InputId FROM account_id_map WHERE RemoteId IS NOT NULL)""",
)
def contact_data(t: Tables):
    routed = accounts.route_contacts(t.app_contacts(), t.view("account_id_map"))
    return accounts.select_contact_data("salesforce", "Contact", routed).select("id", "email")


@check("owner_lookup", f"SELECT * FROM {SQL_OWNERS}")
def owners(t: Tables):
    return enrich.owner_lookup(t.owners())


@check(
    "list_lookup",
    """SELECT CAST(o_custkey AS VARCHAR) AS "listId", max_by(o_orderpriority, o_orderkey) AS name
    FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""",
)
def lists(t: Tables):
    named = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    rows = t.table("orders").select(
        F.col("o_custkey").alias("listId"), named.alias("name"), "o_orderkey"
    )
    return enrich.list_lookup(rows, order_by="o_orderkey")


@check(
    "account_lookup",
    """SELECT InputId, max_by(RemoteId, line) AS RemoteId FROM repeated_id_map
    WHERE RemoteId IS NOT NULL GROUP BY InputId""",
)
def account_map(t: Tables):
    return enrich.account_lookup(t.view("repeated_id_map"), order_by="line")
