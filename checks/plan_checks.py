"""Whole plans, down to the message lines they write."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.filter_checks import SQL_PENDING, SQL_REJECTED, SQL_TRUTHY
from checks.join_checks import SQL_DETAILS, SQL_OWNERS
from checks.registry import check
from checks.scalar_checks import sql_clean
from checks.views import Tables
from crmweave.operators.dedupe import HASH, content_hash
from crmweave.operators.mapping import HUBSPOT_COMPANY_READ_ONLY, drop_read_only, map_stream
from crmweave.plans import common, hubspot, marketo, salesforce
from crmweave.plans.jobs import ENVELOPE_JSON
from crmweave.session import scratch_path
from crmweave.sources.lines import LINE
from crmweave.sinks.singer import observed_types, singer_records, write_singer

SALESFORCE_MAP = {
    "Account": {"name": "Name", "website": "Website", "annual_revenue": "AnnualRevenue"},
    "Contact": {
        "firstName": "FirstName", "last_name": "LastName", "email": "Email",
        "accountId": "AccountId", "zip": "MailingPostalCode",
    },
    "Lead": {"firstName": "FirstName", "last_name": "LastName", "email": "Email", "zip": "PostalCode"},
}


def _sql_object(fields: dict[str, str]) -> str:
    pairs = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    return f"json_object({pairs})"


def sql_line(stream: str, fields: dict[str, str]) -> str:
    """SQL for a RECORD line of flat fields, null ones left out."""
    head = f'{{"type":"RECORD","stream":"{stream}","record":'
    return f"'{head}' || json_merge_patch('{{}}', {_sql_object(fields)})::VARCHAR || '}}'"


def sql_envelope_line(stream: str, source: str, fields: dict[str, str], key: str, lookup: str) -> str:
    """SQL for a RECORD line of an envelope, nulls inside ``data`` kept."""
    head = f'{{"type":"RECORD","stream":"{stream}","record":{{"data":'
    rest = _sql_object({"sourceRecordId": key, "source": f"'{source}'", "lookupKey": lookup})
    return (
        f"'{head}' || {_sql_object(fields)}::VARCHAR || ',' || "
        f"substr(json_merge_patch('{{}}', {rest})::VARCHAR, 2) || '}}'"
    )


def _lines(records: dict[str, DataFrame]) -> DataFrame:
    parts = [singer_records(df, stream) for stream, df in records.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _previous_accounts(t: Tables) -> DataFrame:
    """The account view as the last run saw it."""
    key = F.col("id").cast("long")
    revenue = F.when(key % 5 == 0, F.col("annual_revenue") + 1).otherwise(F.col("annual_revenue"))
    return t.view("crm_accounts").where(key % 9 != 0).withColumn("annual_revenue", revenue)


def _hashes(df: DataFrame) -> DataFrame:
    return df.select("externalId", content_hash(df).alias(HASH))


_SQL_DUE = """(id NOT IN (SELECT InputId FROM account_id_map)
    OR CAST(id AS BIGINT) % 9 = 0 OR CAST(id AS BIGINT) % 5 = 0)"""


@check(
    "sf_accounts_write",
    f"""SELECT {sql_line('Account', {
        'Name': 'name', 'Website': sql_clean('website'), 'AnnualRevenue': 'annual_revenue',
        'externalId': sql_clean('id')})} AS line FROM crm_accounts WHERE {_SQL_DUE}""",
)
def sf_accounts(t: Tables):
    stored = _hashes(map_stream(_previous_accounts(t), "Account", SALESFORCE_MAP))
    result = salesforce.accounts_write(
        t.view("crm_accounts"), SALESFORCE_MAP, t.view("account_id_map"), stored
    )
    return _lines(result.records)


def sf_contacts_result(t: Tables):
    contacts = t.app_contacts().withColumnRenamed("lastName", "last_name")
    old_contacts = t.view("old_contacts").withColumn("MailingPostalCode", F.lit("1,000"))
    return salesforce.contacts_write(
        contacts,
        SALESFORCE_MAP,
        t.view("account_id_map"),
        sent={"Contact": t.view("sent_contacts"), "Lead": t.view("sent_leads")},
        snapshots={"Contact": old_contacts, "Lead": t.view("old_leads")},
        dynamic_contact_mapping=True,
    )


_SQL_COMPANY = """CASE WHEN contains({c}, '@') THEN
    nullif(lower(trim(list_last(string_split({c}, '@')))), '') END"""
_SQL_SF_CONTACTS = f"""WITH synced AS (SELECT * FROM account_id_map WHERE RemoteId IS NOT NULL),
  linked AS (SELECT c.*, s.RemoteId AS remote FROM crm_contacts c
    LEFT JOIN synced s ON s.InputId = c.account_id),
  contact_batch AS (SELECT id AS ext, first_name, last_name, email, account_id, zip
    FROM linked WHERE remote IS NOT NULL),
  lead_batch AS (SELECT id AS ext, first_name, last_name, email, zip
    FROM linked WHERE remote IS NULL AND coalesce(trim(account_id), '') = ''),
  all_contacts AS (SELECT * FROM contact_batch UNION ALL
    SELECT "externalId", "FirstName", "LastName", NULL, "AccountId", '1,000' FROM old_contacts
    WHERE "externalId" NOT IN (SELECT ext FROM contact_batch)
      AND "externalId" NOT IN (SELECT InputId FROM sent_contacts)),
  all_leads AS (SELECT * FROM lead_batch UNION ALL
    SELECT "externalId", "FirstName", "LastName", "Email", NULL FROM old_leads
    WHERE "externalId" NOT IN (SELECT ext FROM lead_batch)
      AND "externalId" NOT IN (SELECT InputId FROM sent_leads))
SELECT {sql_line('Contact', {
    'FirstName': sql_clean('first_name'), 'LastName': 'last_name', 'Email': 'email',
    'AccountId': 's.RemoteId', 'MailingPostalCode': sql_clean('zip'), 'externalId': 'ext'})} AS line
FROM all_contacts LEFT JOIN synced s ON s.InputId = account_id
UNION ALL
SELECT {sql_line('Lead', {
    'FirstName': sql_clean('first_name'), 'LastName': 'last_name', 'Email': 'email',
    'PostalCode': sql_clean('zip'), 'externalId': 'ext', 'Company': _SQL_COMPANY.format(c='email')})}
FROM all_leads"""


@check("sf_contacts_write", _SQL_SF_CONTACTS, large=True)
def sf_contacts(t: Tables):
    return _lines(sf_contacts_result(t).records)


_SQL_DOMAIN = """nullif(regexp_replace(split_part(split_part(
    regexp_replace(lower(trim(website)), '^https?://', ''), '/', 1), '?', 1), '^www[.]', ''), '')"""
_SQL_ADDRESS = """(CASE WHEN nullif(zip, 'none') IS NOT NULL OR account_id IS NOT NULL THEN
    json_merge_patch('{}', to_json({'app': account_id, 'postal': %s})) END)""" % sql_clean("zip")


@check(
    "sf_read",
    f"""WITH accounts AS (SELECT *, {_SQL_DOMAIN} AS domain FROM crm_accounts
      WHERE NOT coalesce(is_deleted, FALSE)),
    ids AS (SELECT RemoteId, max(InputId) AS app FROM account_id_map
      WHERE RemoteId IS NOT NULL GROUP BY RemoteId),
    people AS (SELECT c.*, CASE WHEN account_id <> '' THEN 'R' || account_id END AS crm_account,
      CAST(c.id AS BIGINT) % 2 = 0 AS is_contact FROM crm_contacts c
      WHERE NOT coalesce(archived, FALSE) AND trim(email) <> '')
    SELECT {sql_envelope_line('accounts', 'SALESFORCE', {
        'Id': 'id', 'Name': 'name', 'Website': sql_clean('website'),
        'AnnualRevenue': 'annual_revenue', 'IsDeleted': 'is_deleted', 'domain': 'domain'},
        'id', 'domain')} AS line FROM accounts WHERE domain IS NOT NULL
    UNION ALL
    SELECT {sql_envelope_line('contacts', 'SALESFORCE', {
        'Id': 'id', 'Email': 'email', 'AccountId': 'crm_account', 'IsDeleted': 'archived',
        'accountId': 'app', 'Address': _SQL_ADDRESS}, 'id', 'email')}
    FROM people LEFT JOIN ids ON RemoteId = crm_account WHERE is_contact
    UNION ALL
    SELECT {sql_envelope_line('contacts', 'SALESFORCE', {
        'Id': 'id', 'Email': 'email', 'IsDeleted': 'archived', 'Name': 'last_name'},
        'id', 'email')} FROM people WHERE NOT is_contact""",
)
def sf_read(t: Tables):
    account = t.view("crm_accounts").select(
        F.col("id").alias("Id"), F.col("name").alias("Name"), F.col("website").alias("Website"),
        F.col("annual_revenue").alias("AnnualRevenue"), F.col("is_deleted").alias("IsDeleted"),
    )
    people = t.view("crm_contacts")
    is_contact = F.col("id").cast("long") % 2 == 0
    contact = people.where(is_contact).select(
        F.col("id").alias("Id"), F.col("email").alias("Email"),
        F.when(F.col("account_id") != "", F.concat(F.lit("R"), "account_id")).alias("AccountId"),
        F.col("archived").alias("IsDeleted"),
        F.col("account_id").alias("Address.app"), F.col("zip").alias("Address.postal"),
    )
    lead = people.where(~is_contact).select(
        F.col("id").alias("Id"), F.col("email").alias("Email"),
        F.col("archived").alias("IsDeleted"), F.col("last_name").alias("Name"),
    )
    wrapped = salesforce.read(
        {"Account": account, "Contact": contact, "Lead": lead},
        {"Account": "accounts", "Contact": "contacts", "Lead": "contacts"},
        t.view("account_id_map"),
    )
    parts = [singer_records(df, s, ENVELOPE_JSON) for s, df in wrapped.items()]
    return parts[0].unionByName(parts[1])


def _hubspot_app_contacts(t: Tables) -> DataFrame:
    return t.app_contacts().withColumnRenamed("id", "externalId")


@check(
    "hs_contacts_write",
    f"""SELECT {sql_line('contacts', {
        'externalId': sql_clean('id'), 'lastName': 'last_name',
        'firstName': sql_clean('first_name'), 'email': 'email', 'accountId': 'account_id',
        'company_id': 'company_id', 'owner_id': 'owner_id', 'zip': sql_clean('zip'),
        'rejectionReason': 'rejection_reason', 'list_memberships': sql_clean('list_memberships'),
        'archived': 'archived'})} AS line
    FROM crm_contacts WHERE id NOT IN (SELECT InputId FROM contact_id_map)""",
)
def hs_contacts(t: Tables):
    records = hubspot.contacts_write(_hubspot_app_contacts(t), t.view("contact_id_map"))
    return singer_records(records, "contacts")


@check(
    "hs_accounts_write",
    f"""SELECT {sql_line('companies', {
        'id': 'id', 'name': 'name', 'annual_revenue': 'annual_revenue', 'owner_id': 'owner_id',
        'website': sql_clean('website'), 'is_deleted': 'is_deleted', 'externalId': 'id'})} AS line
    FROM crm_accounts WHERE {_SQL_DUE}""",
)
def hs_accounts(t: Tables):
    def staged(df: DataFrame) -> DataFrame:
        return df.withColumn("hs_object_id", F.concat(F.lit("x"), "id"))

    previous = drop_read_only(staged(_previous_accounts(t)), HUBSPOT_COMPANY_READ_ONLY)
    stored = _hashes(previous.withColumn("externalId", F.col("id")))
    result = hubspot.accounts_write(
        staged(t.view("crm_accounts")), {"accounts": "companies"}, t.view("account_id_map"), stored
    )
    return _lines(result.records)


_SQL_REQUESTS = f"""FROM crm_contacts WHERE {SQL_TRUTHY} AND NOT {SQL_PENDING}
    AND NOT {SQL_REJECTED} AND trim(email) <> ''"""
_SQL_PATH = "'communication-preferences/v4/statuses/' || url_encode(email) || '/unsubscribe-all?channel=EMAIL'"


@check("unsubscribe_requests", f"SELECT email, {_SQL_PATH} AS path {_SQL_REQUESTS}")
def unsubscribe(t: Tables):
    return hubspot.unsubscribe_requests(t.app_contacts())


@check("hs_unsubscribe", f"SELECT email, {_SQL_PATH} AS path {_SQL_REQUESTS}")
def hs_unsubscribe(t: Tables):
    return hubspot.unsubscribe_requests(_hubspot_app_contacts(t))


_SQL_FLAG = """CASE WHEN lower(global_unsubscribe) IN ('true', 'false')
    THEN lower(global_unsubscribe)::JSON ELSE to_json(global_unsubscribe) END"""
_SQL_COMPANY_DATA = {
    "id": "id", "name": "name", "annual_revenue": "annual_revenue", "domain": "domain",
    "archived": "is_deleted", "is_public": "CAST(NULL AS VARCHAR)",
    "crmOwnerName": '"crmOwnerName"', "crmOwnerEmail": '"crmOwnerEmail"',
    "crmListMembershipDetails": "CAST(NULL AS JSON)",
}


@check(
    "hs_read",
    f"""WITH owners AS {SQL_OWNERS},
    companies AS (SELECT *, {_SQL_DOMAIN} AS domain FROM crm_accounts)
    SELECT {sql_envelope_line('contacts', 'HUBSPOT', {
        'id': sql_clean('id'), 'last_name': 'last_name', 'first_name': sql_clean('first_name'),
        'email': 'email', 'account_id': 'account_id', 'zip': sql_clean('zip'),
        'global_unsubscribe': _SQL_FLAG, 'pending_fields': 'pending_fields',
        'rejection_reason': 'rejection_reason', 'archived': 'archived', 'accountId': 'm.RemoteId',
        'crmOwnerName': '"crmOwnerName"', 'crmOwnerEmail': '"crmOwnerEmail"',
        'crmListMembershipDetails': f'{SQL_DETAILS}::JSON'}, 'id', 'email')} AS line
    FROM crm_contacts c LEFT JOIN account_id_map m ON m.InputId = company_id
    LEFT JOIN owners ON owner_id = owner_key
    WHERE NOT coalesce(archived, FALSE) AND trim(email) <> ''
    UNION ALL
    SELECT {sql_envelope_line('accounts', 'HUBSPOT', _SQL_COMPANY_DATA, 'id', 'domain')}
    FROM companies LEFT JOIN owners ON owner_id = owner_key
    WHERE NOT coalesce(is_deleted, FALSE) AND domain IS NOT NULL""",
    large=True,
)
def hs_read(t: Tables):
    companies = salesforce.add_domain(
        t.view("crm_accounts").withColumnRenamed("website", "Website")
    ).select(
        "id", "name", "annual_revenue", F.col("owner_id").alias("hubspot_owner_id"), "domain",
        F.col("is_deleted").alias("archived"),
    )
    wrapped = hubspot.read(
        {"contacts": t.hubspot_contacts(), "companies": companies, "owners": t.owners(),
         "lists": t.lists()},
        {"contacts": "contacts", "accounts": "companies"},
        t.view("account_id_map"),
    )
    parts = [singer_records(df, s, ENVELOPE_JSON) for s, df in wrapped.items()]
    return parts[0].unionByName(parts[1])


@check(
    "hs_read_repeated_accounts",
    """WITH last AS (SELECT InputId, max_by(RemoteId, line) AS account FROM repeated_id_map
      WHERE RemoteId IS NOT NULL GROUP BY InputId)
    SELECT id AS "sourceRecordId", account FROM crm_contacts LEFT JOIN last ON InputId = company_id
    WHERE NOT coalesce(archived, FALSE) AND trim(email) <> ''""",
    large=True,
)
def hs_read_last(t: Tables):
    accounts = t.view("repeated_id_map").withColumnRenamed("line", LINE)
    wrapped = hubspot.read({"contacts": t.hubspot_contacts()}, {"contacts": "contacts"}, accounts)
    account = F.get_json_object("data", "$.accountId").alias("account")
    return wrapped["contacts"].select("sourceRecordId", account)


@check(
    "mk_contacts_write",
    f"""SELECT {sql_line('leads', {
        'externalId': sql_clean('id'), 'last_name': 'last_name', 'email': 'email',
        'zip': sql_clean('zip')})} AS line
    FROM crm_contacts WHERE id NOT IN (SELECT InputId FROM contact_id_map)""",
)
def mk_contacts(t: Tables):
    contacts = t.view("crm_contacts").select(
        F.col("id").alias("externalId"), "last_name", "email", "zip",
        F.col("archived").alias("isAnonymous"), F.col("owner_id").alias("createdAt"),
    )
    records = marketo.contacts_write(contacts, t.view("contact_id_map"))
    return singer_records(records, marketo.output_name({}))


@check(
    "mk_read",
    f"""SELECT {sql_envelope_line('leads', 'MARKETO', {
        'id': sql_clean('id'), 'first_name': sql_clean('first_name'), 'email': 'email',
        'zip': sql_clean('zip'), 'global_unsubscribe': 'global_unsubscribe'}, 'id', 'email')} AS line
    FROM crm_contacts WHERE trim(email) <> ''""",
)
def mk_read(t: Tables):
    leads = t.view("crm_contacts").select("id", "first_name", "email", "zip", "global_unsubscribe")
    return singer_records(marketo.read_stream(leads), "leads", ENVELOPE_JSON)


@check(
    "passthrough_write",
    f"""SELECT {sql_line('orders', {
        'o_orderkey': 'o_orderkey', 'o_custkey': 'o_custkey', 'o_orderstatus': 'o_orderstatus',
        'o_totalprice': 'o_totalprice',
        'o_orderdate': "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%fZ')",
        'o_orderpriority': 'o_orderpriority'})} AS line FROM orders""",
)
def passthrough(t: Tables):
    return singer_records(common.passthrough_write(t.table("orders")), "orders")


@check(
    "mapped_write",
    f"""SELECT {sql_line('companies', {
        'company': 'name', 'domain': sql_clean('website'), 'externalId': 'id'})} AS line
    FROM crm_accounts WHERE id NOT IN (SELECT InputId FROM account_id_map)""",
)
def mapped(t: Tables):
    records = common.mapped_write(
        t.view("crm_accounts"), "accounts", {"accounts": {"name": "company", "website": "domain"}},
        t.view("account_id_map"),
    )
    return singer_records(records, "companies")


def _written_lines(t: Tables) -> DataFrame:
    folder = scratch_path(t.spark, "output")
    leads = t.view("crm_contacts").select("id", "first_name", "email", "zip")
    path = write_singer(marketo.read_stream(leads), "leads", folder, ENVELOPE_JSON)
    return t.spark.read.text(f"{path}/*").withColumnRenamed("value", "line")


@check(
    "singer_records",
    f"""SELECT {sql_envelope_line('leads', 'MARKETO', {
        'id': sql_clean('id'), 'first_name': sql_clean('first_name'), 'email': 'email',
        'zip': sql_clean('zip')}, 'id', 'email')} AS line
    FROM crm_contacts WHERE trim(email) <> ''""",
)
def records(t: Tables):
    return _written_lines(t).where(F.startswith("line", F.lit('{"type":"RECORD"')))


_SCHEMA = json.dumps({
    "type": "SCHEMA", "stream": "leads",
    "schema": {"type": "object", "properties": {
        "data": {"type": ["null", "boolean", "string", "integer", "number", "object"]},
        "sourceRecordId": {"type": ["null", "boolean", "string", "integer", "number"]},
        "source": {"type": ["null", "boolean", "string", "integer", "number"]},
        "lookupKey": {"type": ["null", "boolean", "string", "integer", "number"]},
    }},
    "key_properties": [],
}, separators=(",", ":"))


@check("singer_schema", f"SELECT DISTINCT '{_SCHEMA}' AS line FROM crm_contacts")
def schema(t: Tables):
    return _written_lines(t).where(F.startswith("line", F.lit('{"type":"SCHEMA"')))


@check(
    "observed_types",
    """SELECT 'props' AS column_name, bool_or(props LIKE '{%') AS has_object,
    bool_or(props LIKE '[%') AS has_array FROM events
    UNION ALL
    SELECT 'list_memberships', bool_or(list_memberships LIKE '{%'),
    bool_or(list_memberships LIKE '[%') FROM crm_contacts""",
)
def observed(t: Tables):
    events = observed_types(t.table("events"), ("props",))
    return events.unionByName(observed_types(t.view("crm_contacts"), ("list_memberships",)))
