"""Sources and tenant configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.registry import check
from checks.views import Tables
from crmweave.operators.dedupe import latest_per_key
from crmweave.session import scratch_path
from crmweave.sources import tenants
from crmweave.sources.id_maps import read_id_map
from crmweave.sources.lines import LINE
from crmweave.sources.streams import read_typed, scan_stream


@check("scan_stream", "SELECT * FROM customer")
def scan(t: Tables):
    return scan_stream(t.spark, t.sf_dir, "customer")


@check(
    "read_typed",
    "SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_note FROM orders",
)
def typed(t: Tables):
    return read_typed(t.spark, t.sf_dir, "orders", "o_orderkey long, o_totalprice double, o_note string")


def _message_lines(events: DataFrame) -> DataFrame:
    """The whole events table as message lines, good and bad, nine kinds in turn."""
    record = F.to_json(F.struct("event_id", "event_type", "value"))
    message = lambda head: F.concat(F.lit(head), record, F.lit("}"))
    kind = F.col("event_id") % 9
    return events.select(
        F.when(kind == 0, message('{"type":"RECORD","stream":"events","record":'))
        .when(kind == 1, message('{"type":"RECORD","record":'))
        .when(kind == 2, message('{"type":"RECORD","stream":"others","record":'))
        .when(kind == 3, message('{"type":"SCHEMA","stream":"events","schema":'))
        .when(kind == 4, message('{"type":"STATE","value":'))
        .when(kind == 5, record)
        .when(kind == 6, F.concat(record, F.lit(" trailing")))
        .when(kind == 7, F.concat(F.lit("["), record, F.lit("]")))
        .otherwise(F.lit("  "))
        .alias("line")
    )


@check(
    "scan_records",
    "SELECT event_id, event_type, value FROM events WHERE event_id % 9 IN (0, 1, 5)",
)
def scan_lines(t: Tables):
    folder = scratch_path(t.spark, "staged")
    _message_lines(t.table("events")).write.text(f"{folder}/events-1.singer")
    return scan_stream(t.spark, folder, "events", "event_id long, event_type string, value double")


_MIXED = """SELECT {id} AS id, c_name AS name, {balance} AS balance, {tags} AS tags
  FROM customer WHERE c_custkey % 3 = {third}"""


@check(
    "scan_stream_mixed",
    "\nUNION ALL\n".join([
        _MIXED.format(third=0, id="CAST(c_custkey AS VARCHAR)", balance="c_custkey * 1.0::DOUBLE", tags="NULL"),
        _MIXED.format(third=1, id="'c' || c_custkey", balance="c_acctbal::DOUBLE", tags="c_mktsegment"),
        _MIXED.format(
            third=2, id="CAST(c_custkey AS VARCHAR)", balance="NULL",
            tags="""'{"k":' || c_nationkey || ',"s":"' || c_mktsegment || '"}'""",
        ),
    ]),
)
def scan_mixed(t: Tables):
    """Files of one stream with ids as numbers and as text, and a column of three types."""
    folder = scratch_path(t.spark, "staged")
    customers = t.table("customer")
    files = [
        ("c_custkey AS id", "CAST(c_custkey AS int) AS balance", "CAST(NULL AS int) AS tags"),
        ("'c' || c_custkey AS id", "CAST(c_acctbal AS double) AS balance", "c_mktsegment AS tags"),
        ("CAST(c_custkey AS int) AS id", None, "struct(c_nationkey AS k, c_mktsegment AS s) AS tags"),
    ]
    for third, columns in enumerate(files):
        part = customers.where(F.col("c_custkey") % 3 == third)
        part = part.selectExpr("c_name AS name", *[c for c in columns if c])
        part.write.parquet(f"{folder}/customers-{third}.parquet")
    found = scan_stream(t.spark, folder, "customers")
    return found.select("id", "name", "balance", "tags")


@check(
    "scan_records_last",
    """SELECT user_id, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
)
def scan_last(t: Tables):
    """Message files in which the last record of a user counts."""
    folder = scratch_path(t.spark, "staged")
    lines = t.table("events").select("event_id", "user_id", "value").sort("event_id")
    record = F.to_json(F.struct("event_id", "user_id", "value"))
    lines.select(record).coalesce(1).write.text(f"{folder}/events-1.jsonl")
    records = scan_stream(t.spark, folder, "events", with_line=True)
    last = latest_per_key(records, "user_id", LINE)
    return last.select("user_id", "event_id", "value")


@check("read_id_map", "SELECT InputId, RemoteId FROM account_id_map")
def id_map(t: Tables):
    folder = scratch_path(t.spark, "snapshots")
    t.view("account_id_map").write.option("header", True).csv(f"{folder}/Account_f1.snapshot.csv")
    return read_id_map(t.spark, folder, "Account", "f1")


# One tenant per supplier. Which keys its flow has depends on the supplier.
_KEYS = [
    ("s_suppkey % 3 <> 1", "accounts/Account", {"name": "Name", "website": "Website"}),
    ("TRUE", "contacts/Contact", {"firstName": "FirstName", "hqLocation.city": "City"}),
    ("s_suppkey % 3 <> 2", "contacts/Lead", {"email": "Email"}),
    ("s_suppkey % 4 = 0", "accounts/companies", {"name": "name"}),
    ("TRUE", "malformed", {"a": "b"}),
]


def _configs(t: Tables) -> DataFrame:
    entries = []
    for condition, key, fields in _KEYS:
        text = ",".join(f'"{k}":"{v}"' for k, v in fields.items())
        entries.append(F.when(F.expr(condition), F.lit(f'"{key}":{{{text}}}')))
    flow = F.concat(F.lit('"F'), F.col("s_nationkey"), F.lit('":{'))
    config = F.concat(
        F.lit('{"about":{"name":"x"},"version":3,"sync":{"mapping":{'), flow,
        F.concat_ws(",", *entries), F.lit("}}}}"),
    )
    return t.table("supplier").select(
        F.col("s_name").alias("tenant"),
        F.concat(F.lit("F"), "s_nationkey").alias("flow"),
        config.alias("config"),
    )


_SPEC = "\n  UNION ALL ".join(
    f"SELECT s_name AS tenant, 'F' || s_nationkey AS flow, {i} AS key_no, '{key}' AS key,"
    f" {pos} AS pos, '{source}' AS source_field, '{target}' AS target_field"
    f" FROM supplier WHERE {condition}"
    for i, (condition, key, fields) in enumerate(_KEYS)
    for pos, (source, target) in enumerate(fields.items())
)
_SQL_KEYS = f"""WITH spec AS ({_SPEC}),
entries AS (SELECT *, dense_rank() OVER (PARTITION BY tenant, flow ORDER BY key_no) - 1 AS ord,
  split_part(key, '/', 1) AS target, split_part(key, '/', 2) AS connector FROM spec)"""


@check(
    "load_mapping",
    f"""{_SQL_KEYS} SELECT tenant, flow, target, connector, CAST(ord AS INTEGER) AS ord,
    CAST(pos AS INTEGER) AS pos, source_field, target_field FROM entries WHERE connector <> ''""",
)
def load_mapping(t: Tables):
    return tenants.load_mapping(_configs(t).drop("flow"))


def _fields_rows(mapping: DataFrame, name: str) -> DataFrame:
    return mapping.select("tenant", "flow", name, F.explode("fields").alias("source_field", "target_field"))


@check(
    "mapping_by_target",
    f"""{_SQL_KEYS} SELECT tenant, flow, target, source_field, target_field FROM entries
    QUALIFY ord = max(ord) OVER (PARTITION BY tenant, flow, target)""",
)
def by_target(t: Tables):
    return _fields_rows(tenants.mapping_by_target(_configs(t).drop("flow")), "target")


@check(
    "mapping_by_connector",
    f"""{_SQL_KEYS} SELECT tenant, flow, connector, source_field, target_field FROM entries
    WHERE connector <> '' QUALIFY ord = max(ord) OVER (PARTITION BY tenant, flow, connector)""",
)
def by_connector(t: Tables):
    return _fields_rows(tenants.mapping_by_connector(_configs(t).drop("flow")), "connector")


def _available(t: Tables, names: list[str]) -> DataFrame:
    streams = F.explode(F.array(*[F.lit(n) for n in names])).alias("stream")
    return _configs(t).select("tenant", "flow", streams)


_SQL_STREAMS = """available AS (SELECT s_name AS tenant, 'F' || s_nationkey AS flow, u.stream
  FROM supplier, unnest({names}) AS u(stream))"""
_CONNECTOR_STREAMS = ["Account", "Contact", "Lead", "companies", "owners"]
_APP_STREAMS = ["accounts", "contacts", "owners"]
_SQL_CONNECTORS = _SQL_STREAMS.format(names=_CONNECTOR_STREAMS)
_SQL_APP = _SQL_STREAMS.format(names=_APP_STREAMS)


@check(
    "stream_routing",
    f"""{_SQL_KEYS}, {_SQL_CONNECTORS},
    named AS (SELECT tenant, flow, target, max_by(connector, ord) AS connector FROM entries
      WHERE connector <> '' GROUP BY ALL)
    SELECT DISTINCT 'salesforce' AS crm, tenant, flow, stream, target AS output_stream
    FROM available JOIN entries e USING (tenant, flow) WHERE e.connector = stream
    UNION ALL
    SELECT 'hubspot', a.tenant, a.flow, stream, coalesce(n.target, stream)
    FROM available a LEFT JOIN named n
      ON a.tenant = n.tenant AND a.flow = n.flow AND n.connector = a.stream""",
)
def routing(t: Tables):
    configs = _configs(t).drop("flow")
    available = _available(t, _CONNECTOR_STREAMS)
    parts = [
        tenants.stream_routing(available, configs, crm).withColumn("crm", F.lit(crm))
        for crm in ("salesforce", "hubspot")
    ]
    return parts[0].unionByName(parts[1])


@check(
    "write_policy",
    f"""{_SQL_KEYS}, {_SQL_APP},
    crms AS (SELECT unnest(['salesforce', 'hubspot', 'marketo']) AS crm)
    SELECT crm, tenant, flow, stream FROM available a, crms WHERE stream = 'contacts'
    OR (stream = 'accounts' AND EXISTS (SELECT 1 FROM entries e WHERE e.tenant = a.tenant
      AND e.flow = a.flow AND ((crm = 'salesforce' AND e.connector = 'Account')
      OR (crm = 'hubspot' AND e.target = 'accounts'))))""",
)
def policy(t: Tables):
    configs = _configs(t).drop("flow")
    available = _available(t, _APP_STREAMS)
    parts = [
        tenants.write_policy(available, configs, crm).withColumn("crm", F.lit(crm))
        for crm in ("salesforce", "hubspot", "marketo")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
