"""Counts of a run."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.filter_checks import FIELD, SQL_PENDING, SQL_REJECTED
from checks.join_checks import SQL_DETAILS
from checks.registry import check
from checks.scalar_checks import SQL_CONTAINER, SQL_GROUPED, SQL_TOKEN
from checks.views import Tables
from crmweave.operators import reports
from crmweave.plans import hubspot

_LINKED = "(SELECT InputId FROM account_id_map WHERE RemoteId IS NOT NULL)"


@check(
    "split_counts",
    f"""SELECT count(*) AS total, count_if(coalesce(account_id IN {_LINKED}, FALSE)) AS contacts,
    count_if(NOT coalesce(account_id IN {_LINKED}, FALSE)) AS leads FROM crm_contacts""",
)
def split_counts(t: Tables):
    return reports.split_counts(t.app_contacts(), t.view("account_id_map"))


@check(
    "held_back_count",
    f"""SELECT count_if(trim(account_id) <> '' AND account_id NOT IN {_LINKED}) AS held_back
    FROM crm_contacts""",
)
def held_back(t: Tables):
    return reports.held_back_count(t.app_contacts(), t.view("account_id_map"))


@check(
    "removed_counts",
    """SELECT count(*) AS total, count_if(archived) AS flagged,
    count_if(NOT coalesce(archived, FALSE) AND trim(coalesce(email, '')) = '') AS without_lookup_key
    FROM crm_contacts""",
)
def removed(t: Tables):
    return reports.removed_counts(t.view("crm_contacts"), "archived", "email")


@check(
    "approval_counts",
    f"""SELECT count_if({SQL_PENDING}) AS pending, count_if({SQL_REJECTED}) AS rejected,
    count_if({SQL_PENDING} OR {SQL_REJECTED}) AS skipped FROM crm_contacts""",
)
def approvals(t: Tables):
    return reports.approval_counts(t.app_contacts(), FIELD)


@check(
    "enrichment_coverage",
    f"""SELECT count(*) AS total, count(m.RemoteId) AS with_account,
    count({SQL_DETAILS}) AS with_memberships
    FROM crm_contacts c LEFT JOIN account_id_map m ON m.InputId = c.company_id
    WHERE NOT coalesce(archived, FALSE)""",
)
def coverage(t: Tables):
    lookups = hubspot.prepare_lookups(t.owners(), t.lists(), t.view("account_id_map"))
    enriched = hubspot.enrich_read(t.hubspot_contacts(), "contacts", lookups)
    return reports.enrichment_coverage(enriched)


_REPORTED = ["first_name", "zip", "list_memberships", "pending_fields", "email"]


@check(
    "sanitize_report",
    f"""WITH entries AS ({" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value FROM crm_contacts" for c in _REPORTED)}
    UNION ALL SELECT 'text', text FROM documents),
    judged AS (SELECT column_name, CASE WHEN {SQL_TOKEN.format(c="value")} THEN 'nonfinite'
      WHEN {SQL_GROUPED.format(c="value")} THEN 'comma_number'
      WHEN {SQL_CONTAINER.format(c="value")} THEN 'flagged_container' END AS reason FROM entries)
    SELECT column_name, reason, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY ALL""",
)
def sanitize_report(t: Tables):
    contacts = reports.sanitize_report(t.view("crm_contacts").select(*_REPORTED))
    return contacts.unionByName(reports.sanitize_report(t.table("documents").select("text")))
