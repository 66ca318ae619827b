"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.registry import check
from checks.views import Tables
from crmweave.operators import filters
from crmweave.operators.accounts import hold_back_pending

FIELD = "globalUnsubscribe"

SQL_PENDING = """(CASE WHEN pending_fields IS NULL OR lower(trim(pending_fields)) IN ('', 'null', 'none', '[]')
    THEN FALSE WHEN starts_with(trim(pending_fields), '[') AND json_valid(pending_fields)
    THEN list_contains(from_json(pending_fields, '["VARCHAR"]'), 'globalUnsubscribe')
    ELSE contains(pending_fields, 'globalUnsubscribe') END)"""
SQL_REJECTED = "(lower(trim(coalesce(rejection_reason, ''))) NOT IN ('', 'null', 'none'))"
SQL_TRUTHY = "coalesce(lower(trim(global_unsubscribe)) IN ('true', '1'), FALSE)"


@check("drop_archived", "SELECT id, email FROM crm_contacts WHERE NOT coalesce(archived, FALSE)")
def archived(t: Tables):
    return filters.drop_archived(t.view("crm_contacts")).select("id", "email")


@check("drop_deleted", "SELECT id, website FROM crm_accounts WHERE NOT coalesce(is_deleted, FALSE)")
def deleted(t: Tables):
    accounts = t.view("crm_accounts").withColumnRenamed("is_deleted", "IsDeleted")
    return filters.drop_deleted(accounts).select("id", "website")


@check("require_lookup_key", "SELECT id, email FROM crm_contacts WHERE trim(email) <> ''")
def lookup_key(t: Tables):
    return filters.require_lookup_key(t.view("crm_contacts"), "email").select("id", "email")


_NUMBER = "CASE CAST(id AS INT) % 3 WHEN 0 THEN double('NaN') WHEN 1 THEN 1D ELSE 0D END"


@check(
    "truthy_flag",
    f"""SELECT id, {SQL_TRUTHY} AS asked, coalesce(archived, FALSE) AS archived,
    CAST(id AS INT) % 3 = 1 AS number FROM crm_contacts""",
)
def truthy(t: Tables):
    return t.view("crm_contacts").select(
        "id",
        filters.truthy_flag(F.col("global_unsubscribe"), T.StringType()).alias("asked"),
        filters.truthy_flag(F.col("archived"), T.BooleanType()).alias("archived"),
        filters.truthy_flag(F.expr(_NUMBER), T.DoubleType()).alias("number"),
    )


@check("not_pending", f"SELECT id, NOT {SQL_PENDING} AS ok FROM crm_contacts")
def pending(t: Tables):
    ok = filters.not_pending("pending_fields", T.StringType(), FIELD)
    return t.view("crm_contacts").select("id", ok.alias("ok"))


@check("not_rejected", f"SELECT id, NOT {SQL_REJECTED} AS ok FROM crm_contacts")
def rejected(t: Tables):
    ok = filters.not_rejected(F.col("rejection_reason"), T.StringType())
    return t.view("crm_contacts").select("id", ok.alias("ok"))


@check(
    "approval_gate",
    f"SELECT id FROM crm_contacts WHERE NOT {SQL_PENDING} AND NOT {SQL_REJECTED}",
)
def gate(t: Tables):
    return filters.approval_gate(t.app_contacts(), FIELD).select("id")


@check(
    "hold_back_pending",
    """SELECT id, account_id AS "accountId" FROM crm_contacts c
    WHERE coalesce(trim(account_id), '') = '' OR EXISTS (SELECT 1 FROM account_id_map m
      WHERE m.InputId = c.account_id AND m.RemoteId IS NOT NULL)""",
)
def held(t: Tables):
    kept = hold_back_pending(t.app_contacts(), t.view("account_id_map"))
    return kept.select("id", "accountId")
