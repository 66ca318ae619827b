"""Field mappings of many tenants as one table, and what follows from them.

Each tenant has one JSON document; the mapping sits in the block that has a ``mapping`` object:
``{block: {"mapping": {flow: {"target/connector": {source field: target field}}}}}``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The streams that each connector may write.
CONTACTS, ACCOUNTS = "contacts", "accounts"
SALESFORCE_ACCOUNT = "Account"

_BLOCKS = "map<string,string>"
_FLOWS = "map<string,map<string,map<string,string>>>"


def read_tenant_configs(spark: SparkSession, path: str) -> DataFrame:
    """``(tenant, config)``: one row per file, the file's path as tenant."""
    files = spark.read.text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("tenant"), F.col("value").alias("config"))


def mapping_keys(configs: DataFrame) -> DataFrame:
    """Every mapping key of every flow, in document order: (tenant, flow, ord, key, fields)."""
    blocks = configs.select("tenant", F.explode(F.from_json("config", _BLOCKS)).alias("b", "v"))
    mapping = F.from_json(F.get_json_object("v", "$.mapping"), _FLOWS)
    flows = blocks.select("tenant", F.explode(mapping).alias("flow", "keys"))
    return flows.select("tenant", "flow", F.posexplode("keys").alias("ord", "key", "fields"))


def _two_parts(keys: DataFrame) -> DataFrame:
    parts = F.split("key", "/")
    return keys.where(F.size(parts) == 2).select(
        "tenant", "flow", "ord", F.get(parts, F.lit(0)).alias("target"),
        F.get(parts, F.lit(1)).alias("connector"), "fields",
    )


def load_mapping(configs: DataFrame) -> DataFrame:
    """One row per mapped field; keys that are not ``target/connector`` are left out.

    ``ord`` and ``pos`` are the positions of key and field in the document.
    """
    return _two_parts(mapping_keys(configs)).select(
        "tenant", "flow", "target", "connector", "ord",
        F.posexplode("fields").alias("pos", "source_field", "target_field"),
    )


def _last_by(keys: DataFrame, name: Column, alias: str, *values: str) -> DataFrame:
    last = F.max_by(F.struct("ord", *values), "ord").alias("last")
    return keys.groupBy("tenant", "flow", name.alias(alias)).agg(last).select(
        "tenant", "flow", alias, *[F.col("last").getField(v).alias(v) for v in values]
    )


def mapping_by_target(configs: DataFrame) -> DataFrame:
    """A flow's field maps keyed by target; of keys with one target the last wins."""
    return _last_by(mapping_keys(configs), F.split("key", "/")[0], "target", "fields")


def mapping_by_connector(configs: DataFrame) -> DataFrame:
    """A flow's field maps keyed by connector object."""
    return _last_by(_two_parts(mapping_keys(configs)), F.col("connector"), "connector", "fields")


def flow_mapping(configs: DataFrame, tenant: str, flow: str) -> dict[str, dict[str, str]]:
    """One flow of one tenant as ``{"target/connector": {source field: target field}}``.

    In document order, the form in which a run takes its mapping. Only that tenant's document
    is parsed, and its keys are few.
    """
    keys = mapping_keys(configs.where(F.col("tenant") == tenant)).where(F.col("flow") == flow)
    rows = sorted(keys.select("ord", "key", "fields").collect(), key=lambda r: r["ord"])
    return {r["key"]: dict(r["fields"] or {}) for r in rows}


def tenant_mapping(mapping: DataFrame, tenant: str, flow: str) -> dict[str, dict[str, str]]:
    """One flow of one tenant as a dict; ``mapping`` is keyed by target or connector."""
    name = next(c for c in ("connector", "target") if c in mapping.columns)
    rows = mapping.where((F.col("tenant") == tenant) & (F.col("flow") == flow)).collect()
    return {r[name]: dict(r["fields"]) for r in rows}


def stream_routing(available: DataFrame, configs: DataFrame, crm: str) -> DataFrame:
    """Output stream of each available connector stream (tenant, flow, stream).

    Salesforce reads only mapped streams; the others pass unmapped ones under their own name.
    """
    # Salesforce routes by every key; the others invert the one-per-target names.
    source = _two_parts(mapping_keys(configs)) if crm == "salesforce" else (
        stream_names_with_order(configs)
    )
    routes = _last_by(source, F.col("connector"), "stream", "target")
    joined = available.join(
        routes, ["tenant", "flow", "stream"], "inner" if crm == "salesforce" else "left"
    )
    return joined.select(
        "tenant", "flow", "stream", F.coalesce("target", "stream").alias("output_stream")
    )


def stream_names_with_order(configs: DataFrame) -> DataFrame:
    """(tenant, flow, target, connector): the connector stream each target is written to.

    ``ord`` is the position at which the target was first named.
    """
    keys = _two_parts(mapping_keys(configs))
    last = F.max_by(F.struct("connector"), "ord").alias("last")
    grouped = keys.groupBy("tenant", "flow", "target").agg(last, F.min("ord").alias("ord"))
    return grouped.select("tenant", "flow", "ord", "target", "last.connector")


def write_policy(available: DataFrame, configs: DataFrame, crm: str) -> DataFrame:
    """The available app streams (tenant, flow, stream) that are written to the CRM.

    Contacts always; accounts where the flow maps them and the CRM takes accounts.
    """
    contacts = available.where(F.col("stream") == CONTACTS)
    if crm == "marketo":
        return contacts
    keys = _two_parts(mapping_keys(configs))
    mapped = F.col("connector") == SALESFORCE_ACCOUNT if crm == "salesforce" else (
        F.col("target") == ACCOUNTS
    )
    accounts = available.where(F.col("stream") == ACCOUNTS).join(
        keys.where(mapped), ["tenant", "flow"], "left_semi"
    )
    return contacts.unionByName(accounts)
