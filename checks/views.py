"""CRM-shaped views of the given tables, as SQL text that Spark and DuckDB both read.

Every view covers its whole table. Remainders of ids decide which rows are dirty, deleted, sent
or changed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from crmweave.session import prepare_session

BASE_TABLES = ["region", "nation", "customer", "supplier", "orders", "events", "pages", "documents"]

VIEWS = {
    "crm_accounts": """
SELECT CAST(s_suppkey AS STRING) AS id, s_name AS name, s_acctbal AS annual_revenue,
  CAST(s_nationkey AS STRING) AS owner_id,
  CASE WHEN s_suppkey % 11 = 0 THEN NULL WHEN s_suppkey % 11 = 1 THEN '  '
       WHEN s_suppkey % 4 = 0 THEN 'HTTP://WWW.Supp' || CAST(s_suppkey AS STRING) || '.Example.com/about?x=1'
       WHEN s_suppkey % 4 = 1 THEN 'www.supp' || CAST(s_suppkey AS STRING) || '.example.com'
       WHEN s_suppkey % 4 = 2 THEN 'https://supp' || CAST(s_suppkey AS STRING) || '.example.com?ref=a'
       ELSE 'supp' || CAST(s_suppkey AS STRING) || '.example.com:8080/x' END AS website,
  CASE WHEN s_suppkey % 8 = 0 THEN TRUE WHEN s_suppkey % 8 = 1 THEN NULL ELSE FALSE END AS is_deleted
FROM supplier""",
    "crm_contacts": """
SELECT CAST(c_custkey AS STRING) AS id, c_name AS last_name,
  CASE c_custkey % 10 WHEN 0 THEN 'NaN' WHEN 1 THEN 'Nan' WHEN 2 THEN 'Infinity' ELSE c_mktsegment END AS first_name,
  CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 13 = 1 THEN ' '
       WHEN c_custkey % 13 = 2 THEN 'a/b c+' || CAST(c_custkey AS STRING) || '@Mail.example.com'
       ELSE 'user' || CAST(c_custkey AS STRING) || '@' || lower(c_mktsegment) || '.example.com' END AS email,
  CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN ''
       ELSE CAST(c_custkey % 150 AS STRING) END AS account_id,
  CAST(c_custkey % 120 AS STRING) AS company_id,
  CAST(c_nationkey AS STRING) AS owner_id,
  CASE c_custkey % 8 WHEN 0 THEN '1,316' WHEN 1 THEN '298,' WHEN 2 THEN '12,34' WHEN 3 THEN '1,050'
       WHEN 4 THEN '12,345.67' WHEN 5 THEN '94538' WHEN 6 THEN '10,000' ELSE 'New York, NY' END AS zip,
  CASE c_custkey % 7 WHEN 0 THEN 'true' WHEN 1 THEN ' True ' WHEN 2 THEN '1' WHEN 3 THEN 'false'
       WHEN 4 THEN '0' WHEN 5 THEN 'yes' END AS global_unsubscribe,
  CASE c_custkey % 9 WHEN 0 THEN '["globalUnsubscribe"]' WHEN 1 THEN '["title"]' WHEN 2 THEN '[]'
       WHEN 3 THEN 'null' WHEN 4 THEN 'title,globalUnsubscribe' WHEN 5 THEN 'title' WHEN 6 THEN ' ' END AS pending_fields,
  CASE c_custkey % 6 WHEN 0 THEN 'policy' WHEN 1 THEN ' ' WHEN 2 THEN 'None' WHEN 3 THEN 'null' END AS rejection_reason,
  CASE c_custkey % 11 WHEN 0 THEN '[0, "3", null]' WHEN 1 THEN '1, 4,' WHEN 2 THEN '2' WHEN 3 THEN '[]'
       WHEN 4 THEN '[9]' WHEN 5 THEN '' WHEN 6 THEN '"1"' END AS list_memberships,
  CASE WHEN c_custkey % 8 = 0 THEN TRUE WHEN c_custkey % 8 = 1 THEN NULL ELSE FALSE END AS archived
FROM customer""",
    "crm_owners": """
SELECT CAST(n_nationkey AS STRING) AS id,
  CASE WHEN n_nationkey % 4 = 0 THEN ' ' WHEN n_nationkey % 4 = 1 THEN NULL ELSE ' Ann' END AS first_name,
  CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE n_name || ' ' END AS last_name,
  'owner' || CAST(n_nationkey AS STRING) || '@example.com' AS email,
  n_nationkey % 6 = 0 AS archived
FROM nation""",
    "crm_lists": """
SELECT CAST(r_regionkey AS STRING) AS list_id,
  CASE WHEN r_regionkey = 4 THEN NULL ELSE r_name END AS name
FROM region""",
    "account_id_map": """
SELECT CAST(s_suppkey AS STRING) AS InputId,
  CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 'R' || CAST(s_suppkey AS STRING) END AS RemoteId
FROM supplier WHERE s_suppkey % 3 <> 0""",
    "contact_id_map": """
SELECT CAST(c_custkey AS STRING) AS InputId, 'R' || CAST(c_custkey AS STRING) AS RemoteId
FROM customer WHERE c_custkey % 4 = 0""",
    # What the last run saw: some rows with other content, some not there yet.
    "previous_accounts": """
SELECT CAST(s_suppkey AS STRING) AS externalId, s_name AS name,
  CASE WHEN s_suppkey % 5 = 0 THEN s_acctbal + 1 ELSE s_acctbal END AS annual_revenue
FROM supplier WHERE s_suppkey % 9 <> 0""",
    "current_accounts": """
SELECT CAST(s_suppkey AS STRING) AS externalId, s_name AS name, s_acctbal AS annual_revenue
FROM supplier""",
    # Changes of the current batch, several versions per id.
    "account_changes": """
SELECT CAST(o_custkey AS STRING) AS externalId, o_orderpriority AS priority, o_orderkey AS version
FROM orders""",
    "account_state": """
SELECT CAST(c_custkey AS STRING) AS externalId, 'none' AS priority
FROM customer""",
    # Account map with several rows per CRM id.
    "repeated_id_map": """
SELECT CAST(o_custkey % 150 AS STRING) AS InputId,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE 'A' || CAST(o_orderkey % 1000 AS STRING) END AS RemoteId,
  o_orderkey AS line
FROM orders""",
    # Record snapshot and acknowledgements of earlier Salesforce person batches.
    "old_contacts": """
SELECT CAST(c_custkey + CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE 10000000 END AS STRING) AS externalId,
  'Old' AS FirstName, c_name AS LastName, CAST(c_custkey % 150 AS STRING) AS AccountId
FROM customer WHERE c_custkey % 5 >= 2""",
    "old_leads": """
SELECT CAST(c_custkey + CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE 20000000 END AS STRING) AS externalId,
  'Old' AS FirstName, c_name AS LastName, 'old' || CAST(c_custkey AS STRING) || '@Old.example.com' AS Email
FROM customer WHERE c_custkey % 5 < 2""",
    "sent_contacts": """
SELECT CAST(c_custkey + CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE 10000000 END AS STRING) AS InputId,
  'R' || CAST(c_custkey AS STRING) AS RemoteId
FROM customer WHERE c_custkey % 3 = 0""",
    "sent_leads": """
SELECT CAST(c_custkey + CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE 20000000 END AS STRING) AS InputId,
  'R' || CAST(c_custkey AS STRING) AS RemoteId
FROM customer WHERE c_custkey % 4 < 2""",
}

# App and CRM field names of the contact view's columns.
APP_CONTACT = {
    "first_name": "firstName",
    "last_name": "lastName",
    "account_id": "accountId",
    "global_unsubscribe": "globalUnsubscribe",
    "pending_fields": "pendingCriticalFieldsForCrmSync",
    "rejection_reason": "rejectionReason",
}
HUBSPOT_CONTACT = {
    "company_id": "associatedcompanyid",
    "owner_id": "hubspot_owner_id",
    "list_memberships": "_hg_list_memberships",
}


# Schemas by path: inferring one takes a job of its own.
_SCHEMAS: dict[str, T.StructType] = {}


class Tables:
    """The given tables and the views above, for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare_session(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def view(self, name: str) -> DataFrame:
        text = re.sub(r"FROM (\w+)", r"FROM {\1}", VIEWS[name])
        used = re.findall(r"FROM \{(\w+)\}", text)
        return self.spark.sql(text, **{t: self.table(t) for t in used})

    def app_contacts(self) -> DataFrame:
        return self.view("crm_contacts").withColumnsRenamed(APP_CONTACT)

    def hubspot_contacts(self) -> DataFrame:
        return self.view("crm_contacts").withColumnsRenamed(HUBSPOT_CONTACT)

    def owners(self) -> DataFrame:
        return self.view("crm_owners").withColumnsRenamed(
            {"first_name": "firstName", "last_name": "lastName"}
        )

    def lists(self) -> DataFrame:
        return self.view("crm_lists").withColumnRenamed("list_id", "listId")


def with_views(body: str) -> str:
    """SQL with the views it names in front."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", body)]
    ctes = ",\n".join(f"{v} AS ({VIEWS[v].strip()})" for v in used)
    rest = body.strip()
    if not ctes:
        return rest
    if rest.upper().startswith("WITH "):
        return f"WITH {ctes},\n{rest[5:]}"
    return f"WITH {ctes}\n{rest}"
