"""Projections, nesting and the envelope."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from checks.views import Tables
from crmweave.operators import mapping
from crmweave.operators.accounts import synced_accounts
from crmweave.operators.envelope import union_person_streams, wrap_envelope
from crmweave.operators.nesting import nest_arrays, nest_columns, nest_dotted

# email moves on to the work address: a copy sees the copies before it.
_CHAINED = {"last_name": "email", "email": "WorkEmail", "first_name": "FirstName", "zip": "FirstName"}


@check(
    "map_fields",
    """SELECT last_name AS email, last_name AS "WorkEmail", zip AS "FirstName", id AS "externalId"
    FROM crm_contacts""",
)
def map_fields(t: Tables):
    return mapping.map_fields(t.view("crm_contacts"), _CHAINED)


@check(
    "external_id",
    """SELECT last_name AS remote, 'r' || id AS "Id", id AS "externalId" FROM crm_contacts""",
)
def external_id(t: Tables):
    contacts = t.view("crm_contacts").withColumn("remote_id", F.concat(F.lit("r"), "id"))
    return mapping.map_fields(contacts, {"last_name": "remote", "id": "externalId"})


@check(
    "external_id_guard",
    """SELECT id, email, id AS "externalId" FROM crm_contacts UNION ALL
    SELECT NULL, email, NULL FROM crm_contacts""",
)
def guard(t: Tables):
    contacts = t.view("crm_contacts").select("id", "email")
    with_id = mapping.external_id_guard(contacts)
    without = mapping.external_id_guard(contacts.select("email"))
    return with_id.unionByName(without, allowMissingColumns=True)


@check(
    "drop_read_only",
    """SELECT id, email, archived FROM crm_contacts""",
)
def read_only(t: Tables):
    contacts = t.app_contacts().select(
        "id", "email", "globalUnsubscribe", "pendingCriticalFieldsForCrmSync", "archived",
        F.col("zip").alias("createdate"),
    )
    return mapping.drop_read_only(contacts, mapping.HUBSPOT_CONTACT_READ_ONLY)


@check(
    "ensure_columns",
    """SELECT id, company_id AS associatedcompanyid, CAST(NULL AS VARCHAR) AS hubspot_owner_id,
    CAST(NULL AS VARCHAR) AS _hg_list_memberships FROM crm_contacts""",
)
def ensure(t: Tables):
    from crmweave.plans.hubspot import EXPECTED

    contacts = t.hubspot_contacts().select("id", "associatedcompanyid")
    return mapping.ensure_columns(contacts, EXPECTED["contacts"])


def _json(df, *names):
    return df.withColumns({n: F.to_json(n) for n in names})


@check(
    "nest_dotted",
    """SELECT id, CASE WHEN email IS NOT NULL OR global_unsubscribe IS NOT NULL THEN
    json_merge_patch('{}', to_json({'work': email, 'a.flag': global_unsubscribe}))::VARCHAR
    END AS address FROM crm_contacts""",
)
def dotted(t: Tables):
    contacts = t.view("crm_contacts").select(
        "id", F.col("zip").alias("address"), F.col("email").alias("address.work"),
        F.col("global_unsubscribe").alias("address.a.flag"),
    )
    return _json(nest_dotted(contacts), "address")


@check(
    "nest_array",
    """SELECT id, zip AS "phones[*]", CASE WHEN email IS NOT NULL OR pending_fields IS NOT NULL THEN
    '[' || json_merge_patch('{}', to_json({'mail': email, 'note': pending_fields}))::VARCHAR || ']'
    END AS funding FROM crm_contacts""",
)
def arrays(t: Tables):
    contacts = t.view("crm_contacts").select(
        "id", F.col("zip").alias("phones[*]"), F.col("email").alias("funding[*].mail"),
        F.col("pending_fields").alias("funding[*].note"),
    )
    return _json(nest_arrays(contacts).drop("phones"), "funding")


@check(
    "nest_array_in_array",
    """SELECT id, CASE WHEN len(investors) > 0 THEN
    to_json([{'investors': investors}])::VARCHAR END AS funding FROM (
      SELECT id, list_filter([email, global_unsubscribe, rejection_reason],
        lambda x: x IS NOT NULL) AS investors FROM crm_contacts)""",
)
def nested_arrays(t: Tables):
    contacts = t.view("crm_contacts").select(
        "id", F.col("email").alias("funding[*].investors[*]"),
        F.col("global_unsubscribe").alias("funding[*].investors[*].b"),
        F.col("rejection_reason").alias("funding[*].investors[*].c"),
    )
    return _json(nest_columns(contacts), "funding")


_WRAP_SQL = """SELECT to_json({{'id': id, 'last_name': last_name, 'email': email,
    'account_id': account_id, 'archived': archived}})::VARCHAR AS data,
    id AS "sourceRecordId", '{source}' AS source, email AS "lookupKey"
    FROM crm_contacts WHERE trim(email) <> ''"""


@check("wrap_envelope", _WRAP_SQL.format(source="MARKETO"))
def wrap(t: Tables):
    contacts = t.view("crm_contacts").select("id", "last_name", "email", "account_id", "archived")
    return wrap_envelope(contacts, "MARKETO", "leads")


@check(
    "rename_id_map",
    """SELECT InputId AS "AccountId", RemoteId AS "RemoteAccountId" FROM account_id_map""",
)
def rename(t: Tables):
    return mapping.rename_id_map(t.view("account_id_map"), "AccountId", "RemoteAccountId")


@check(
    "synced_accounts",
    """SELECT InputId AS "AccountId", RemoteId AS "RemoteAccountId" FROM account_id_map
    WHERE RemoteId IS NOT NULL""",
)
def synced(t: Tables):
    return synced_accounts(t.view("account_id_map"))


@check(
    "prune_columns",
    """SELECT global_unsubscribe AS "globalUnsubscribe",
    pending_fields AS "pendingCriticalFieldsForCrmSync",
    rejection_reason AS "rejectionReason", email FROM crm_contacts""",
)
def prune(t: Tables):
    return mapping.prune_columns(t.app_contacts(), mapping.UNSUBSCRIBE_COLUMNS)


@check("select_output", """SELECT email, last_name FROM crm_contacts""")
def output(t: Tables):
    return mapping.select_output(t.view("crm_contacts"), ["email", "absent", "last_name"])


@check(
    "union_person_streams",
    """SELECT to_json({'Id': id, 'Email': email, 'zip': zip})::VARCHAR AS data,
    id AS "sourceRecordId", 'SALESFORCE' AS source, email AS "lookupKey"
    FROM crm_contacts WHERE trim(email) <> '' AND account_id <> ''
    UNION ALL
    SELECT to_json({'Id': id, 'Email': email})::VARCHAR, id, 'SALESFORCE', email
    FROM crm_contacts WHERE trim(email) <> '' AND coalesce(account_id, '') = ''""",
)
def union_people(t: Tables):
    people = t.view("crm_contacts").select(
        F.col("id").alias("Id"), F.col("email").alias("Email"), "zip", "account_id"
    )
    linked = F.coalesce("account_id", F.lit("")) != ""
    options = {"id_field": "Id", "lookup_field": "Email"}
    contacts = wrap_envelope(people.where(linked).drop("account_id"), "SALESFORCE", **options)
    leads = wrap_envelope(people.where(~linked).drop("account_id", "zip"), "SALESFORCE", **options)
    return union_person_streams(contacts, leads)


