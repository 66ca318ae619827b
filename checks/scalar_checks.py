"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from checks.views import Tables
from crmweave.functions import cleaning, jsontext, text
from crmweave.operators.envelope import wrap_envelope

# SQL for the repairs, independent of the library: by parts of the number.
SQL_TOKEN = "{c} IN ('NaN', 'Infinity', '-Infinity')"
SQL_GROUPED = (
    "(regexp_full_match({c}, '[+-]?[0-9]+(,[0-9]+)*,?([0-9]*[.][0-9]+)?') AND contains({c}, ',')"
    " AND NOT regexp_full_match({c}, '[+-]?[0-9]+,[0-9][0-9]?')"
    " AND NOT regexp_matches({c}, '(^|,|[+-])0[0-9]*[1-9][0-9]*(,|$)'))"
)
SQL_CLEAN = (
    f"CASE WHEN {SQL_TOKEN} THEN NULL WHEN {SQL_GROUPED} THEN replace({{c}}, ',', '') ELSE {{c}} END"
)
# A list, or comma-separated literals: enough for every value that occurs in the tables.
_LITERAL = r'''\s*([+-]?(0+|[1-9][0-9]*|[0-9]*[.][0-9]+)|"[^"\\]*"|'[^'\\]*')\s*'''
SQL_CONTAINER = (
    "regexp_full_match({c}, '\\s*(\\[\\s*\\]|\\[" + _LITERAL.replace("'", "''") + "(,"
    + _LITERAL.replace("'", "''") + ")*,?\\s*\\]|" + _LITERAL.replace("'", "''") + "(,"
    + _LITERAL.replace("'", "''") + ")*,\\s*|" + _LITERAL.replace("'", "''") + "(,"
    + _LITERAL.replace("'", "''") + ")+)\\s*')"
)


def sql_clean(c: str) -> str:
    return SQL_CLEAN.format(c=c)


@check(
    "iso_timestamp",
    """SELECT event_id AS row_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso FROM events
    UNION ALL
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%fZ') FROM orders""",
)
def iso_timestamp(t: Tables):
    events = t.table("events").select(
        F.col("event_id").alias("row_id"), cleaning.iso_timestamp("ts").alias("iso")
    )
    orders = t.table("orders").select(
        F.col("o_orderkey").alias("row_id"), cleaning.iso_timestamp("o_orderdate").alias("iso")
    )
    return events.unionByName(orders)


@check(
    "null_nonfinite",
    f"SELECT id, CASE WHEN {SQL_TOKEN.format(c='first_name')} THEN NULL ELSE first_name END"
    " AS first_name FROM crm_contacts",
)
def null_nonfinite(t: Tables):
    return t.view("crm_contacts").select(
        "id", cleaning.null_nonfinite("first_name").alias("first_name")
    )


@check(
    "repair_comma_number",
    f"""SELECT id, CASE WHEN {SQL_GROUPED.format(c='zip')} THEN replace(zip, ',', '') ELSE zip END
    AS zip FROM crm_contacts""",
)
def repair_comma_number(t: Tables):
    return t.view("crm_contacts").select("id", cleaning.repair_comma_number("zip").alias("zip"))


@check(
    "flag_container",
    f"""SELECT id, coalesce({SQL_CONTAINER.format(c='zip')}, FALSE) AS zip_flag,
    coalesce({SQL_CONTAINER.format(c='list_memberships')}, FALSE) AS lists_flag FROM crm_contacts""",
)
def flag_container(t: Tables):
    return t.view("crm_contacts").select(
        "id",
        cleaning.is_container_literal("zip").alias("zip_flag"),
        cleaning.is_container_literal("list_memberships").alias("lists_flag"),
    )


@check(
    "flag_container_documents",
    f"""SELECT count(*) AS n, count_if({SQL_CONTAINER.format(c='text')}) AS containers
    FROM documents""",
)
def flag_container_documents(t: Tables):
    flags = t.table("documents").select(cleaning.is_container_literal("text").alias("f"))
    return flags.agg(F.count("*").alias("n"), F.count_if("f").alias("containers"))


@check(
    "sanitize_record",
    f"""SELECT {sql_clean('id')} AS id, {sql_clean('first_name')} AS first_name,
    {sql_clean('zip')} AS zip, {sql_clean('email')} AS email, archived,
    to_json([{sql_clean('first_name')}, {sql_clean('zip')}])::VARCHAR AS pair,
    to_json({{'zip': {sql_clean('zip')}, 'name': {sql_clean('first_name')}}})::VARCHAR AS object
    FROM crm_contacts""",
)
def sanitize_record(t: Tables):
    nested = t.view("crm_contacts").select(
        "id", "first_name", "zip", "email", "archived",
        F.array("first_name", "zip").alias("pair"),
        F.struct("zip", F.col("first_name").alias("name")).alias("object"),
    )
    clean = cleaning.sanitize_record(nested)
    as_json = {c: F.to_json(c, {"ignoreNullFields": "false"}) for c in ("pair", "object")}
    return clean.withColumns(as_json)


@check(
    "coerce_bool_strings",
    """SELECT id, '{"id":' || to_json(id)::VARCHAR || ',"flag":' ||
    CASE WHEN global_unsubscribe IS NULL THEN 'null'
         WHEN lower(global_unsubscribe) IN ('true', 'false') THEN lower(global_unsubscribe)
         ELSE to_json(global_unsubscribe)::VARCHAR END || ',"list":[' ||
    CASE WHEN global_unsubscribe IS NULL THEN 'null'
         WHEN lower(global_unsubscribe) IN ('true', 'false') THEN lower(global_unsubscribe)
         ELSE to_json(global_unsubscribe)::VARCHAR END || ',"x"]}' AS data FROM crm_contacts""",
)
def coerce_bool_strings(t: Tables):
    rows = t.view("crm_contacts").selectExpr(
        "id", "global_unsubscribe AS flag", "array(global_unsubscribe, 'x') AS list"
    )
    return rows.select("id", jsontext.json_with_bools(rows.schema).alias("data"))


_NAN_IF = """CASE s_suppkey % 4 WHEN 0 THEN CAST('NaN' AS DOUBLE) WHEN 1 THEN CAST('Infinity' AS DOUBLE)
    WHEN 2 THEN CAST('-Infinity' AS DOUBLE) ELSE s_acctbal END"""


@check(
    "clean_nulls",
    f"""SELECT CAST(s_suppkey AS STRING) AS "sourceRecordId",
    to_json({{'id': s_suppkey, 'email': s_name,
              'balance': CASE WHEN isfinite({_NAN_IF}) THEN s_acctbal END,
              'parts': [CASE WHEN isfinite({_NAN_IF}) THEN s_acctbal END]}})::VARCHAR AS data
    FROM supplier""",
)
def clean_nulls(t: Tables):
    balance = F.expr(_NAN_IF)
    rows = t.table("supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("email"),
        balance.alias("balance"), F.array(balance).alias("parts"),
    )
    return wrap_envelope(rows, "X", "contacts").select("sourceRecordId", "data")


_DOMAIN_SQL = """nullif(regexp_replace(split_part(split_part(
    regexp_replace(lower(trim({c})), '^https?://', ''), '/', 1), '?', 1), '^www[.]', ''), '')"""


@check(
    "domain_from_website",
    f"""SELECT id, {_DOMAIN_SQL.format(c='website')} AS domain FROM crm_accounts
    UNION ALL
    SELECT 'page' || CAST(page_id AS STRING), {_DOMAIN_SQL.format(c='url')} FROM pages""",
)
def domain_from_website(t: Tables):
    accounts = t.view("crm_accounts").select(
        "id", text.domain_from_website(F.col("website")).alias("domain")
    )
    pages = t.table("pages").select(
        F.concat(F.lit("page"), "page_id").alias("id"),
        text.domain_from_website(F.col("url")).alias("domain"),
    )
    return accounts.unionByName(pages)


@check(
    "company_from_email",
    """SELECT id, CASE WHEN contains(email, '@') THEN
    nullif(lower(trim(list_last(string_split(email, '@')))), '') END AS company FROM crm_contacts""",
)
def company_from_email(t: Tables):
    return t.view("crm_contacts").select(
        "id", text.company_from_email(F.col("email")).alias("company")
    )


@check(
    "owner_full_name",
    """SELECT id, coalesce(nullif(trim(trim(coalesce(first_name, '')) || ' ' ||
    trim(coalesce(last_name, ''))), ''), email) AS full_name FROM crm_owners
    UNION ALL
    SELECT id, coalesce(nullif(trim(trim(coalesce(first_name, '')) || ' ' ||
    trim(coalesce(last_name, ''))), ''), email) FROM crm_contacts""",
)
def owner_full_name(t: Tables):
    name = text.owner_full_name(F.col("first_name"), F.col("last_name"), F.col("email"))
    owners = t.view("crm_owners").select("id", name.alias("full_name"))
    return owners.unionByName(t.view("crm_contacts").select("id", name.alias("full_name")))


@check(
    "parse_list_ids",
    """SELECT id, CASE c.list_memberships WHEN '[0, "3", null]' THEN '["0","3"]'
    WHEN '1, 4,' THEN '["1","4"]' WHEN '2' THEN '["2"]' WHEN '[9]' THEN '["9"]'
    WHEN '"1"' THEN '["\\"1\\""]' END AS ids FROM crm_contacts c""",
)
def parse_list_ids(t: Tables):
    return t.view("crm_contacts").select(
        "id", F.to_json(text.parse_list_ids("list_memberships")).alias("ids")
    )


@check(
    "id_as_text",
    """SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS customer_id,
    c.id AS contact_id FROM orders LEFT JOIN crm_contacts c ON CAST(o_custkey AS STRING) = c.id""",
)
def id_as_text(t: Tables):
    from crmweave.operators.lookup import lookup_join

    orders = t.table("orders").select(
        text.id_as_text(F.col("o_orderkey")).alias("order_id"), "o_custkey"
    )
    contacts = t.view("crm_contacts").select("id", F.col("id").alias("contact_id"))
    joined = lookup_join(orders, contacts, "o_custkey", "id")
    return joined.withColumn("customer_id", text.id_as_text(F.col("o_custkey"))).drop("o_custkey")
