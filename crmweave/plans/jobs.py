"""Whole runs: staged input folder to message lines and next snapshots.

A run reads ``<input>/<stream>...`` files and ``<snapshots>`` state, writes one directory of
lines per output stream under a fresh ``output_dir``, and then commits all its state at once. A
run that fails has committed nothing, so it can be repeated into a fresh folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from crmweave.jvm import delete_path
from crmweave.operators.accounts import CONTACT, LEAD
from crmweave.operators.mapping import EXTERNAL_ID
from crmweave.plans import common, hubspot, marketo, salesforce
from crmweave.plans.counts import Counts
from crmweave.plans.result import FieldMaps, WriteResult
from crmweave.session import prepare_session, write_and_read
from crmweave.sinks.singer import write_singer
from crmweave.sinks.snapshots import Parts, SnapshotStore
from crmweave.sources.id_maps import read_id_map
from crmweave.sources.lines import LINE
from crmweave.sources.streams import Schema, scan_stream
from crmweave.sources.tenants import flow_mapping

ENVELOPE_JSON = ("data",)
Schemas = dict[str, Schema]


class SyncRun:
    """Paths and tenant settings of one run.

    ``mapping`` is the flow's ``{"target/connector": {source field: target field}}``;
    ``schemas`` gives the input schema per stream, where files alone do not settle it. After
    the run ``counts`` has what was read, split, held back, left out and enriched, by stream.
    """

    def __init__(
        self,
        spark: SparkSession,
        input_dir: str,
        snapshot_dir: str,
        output_dir: str,
        flow: str,
        mapping: FieldMaps,
        schemas: Schemas | None = None,
    ):
        self.spark = prepare_session(spark)
        self.input_dir = input_dir
        self.snapshot_dir = snapshot_dir
        self.output_dir = output_dir
        self.flow = flow
        self.schemas = schemas or {}
        pairs = [(key.split("/"), fields) for key, fields in mapping.items()]
        self.by_target = {parts[0]: fields for parts, fields in pairs}
        pairs = [(parts, fields) for parts, fields in pairs if len(parts) == 2]
        self.by_connector = {connector: fields for (_, connector), fields in pairs}
        self.stream_names = {target: connector for (target, connector), _ in pairs}
        self.routes = {connector: target for (target, connector), _ in pairs}
        self.store = SnapshotStore(self.spark, snapshot_dir)
        self.scratch = f"{output_dir.rstrip('/')}/_scratch"
        self.next_states: dict[str, Parts] = {}
        self.tally = Counts()
        self.counts: dict[str, dict[str, int]] = {}

    @classmethod
    def of_tenant(
        cls,
        configs: DataFrame,
        tenant: str,
        flow: str,
        input_dir: str,
        snapshot_dir: str,
        output_dir: str,
        schemas: Schemas | None = None,
    ) -> SyncRun:
        """The run of one flow of one tenant, its mapping taken from the tenant's document."""
        mapping = flow_mapping(configs, tenant, flow)
        spark = configs.sparkSession
        return cls(spark, input_dir, snapshot_dir, output_dir, flow, mapping, schemas)

    def stream(self, name: str, with_line: bool = False) -> DataFrame | None:
        """A staged stream, or None where it has no files."""
        df = scan_stream(
            self.spark, self.input_dir, name, self.schemas.get(name), with_line, self._scratch_path
        )
        return df if df.columns else None

    def id_map(self, name: str, malformed: str = "raise") -> DataFrame | None:
        return read_id_map(self.spark, self.snapshot_dir, name, self.flow, True, malformed)

    def _scratch_path(self, label: str) -> str:
        return f"{self.scratch}/{label}-{uuid.uuid4().hex}"

    def write_table(self, df: DataFrame, label: str, by: str | None = None) -> DataFrame:
        """An intermediate table in the run's own folder, which lies on shared storage."""
        return write_and_read(df, self._scratch_path(label), by)

    def state(self, name: str, batch: DataFrame | None = None, key: str = EXTERNAL_ID) -> DataFrame | None:
        """Stored state; with ``batch``, the parts of it that the batch's ``key`` can be in."""
        if batch is None or key not in batch.columns:
            return self.store.read(f"{name}_{self.flow}")
        return self.store.read(f"{name}_{self.flow}", batch, key)

    def emit(self, stream: str, df: DataFrame, **options) -> str | None:
        return write_singer(df, stream, self.output_dir, **options)

    def write(self, result: WriteResult) -> list[str]:
        """Write records, and the state that will count them as handled once it is committed."""
        paths = [self.emit(s, df) for s, df in result.records.items()]
        for name, df in result.changes.items():
            key = f"{name}_{self.flow}"
            self.next_states[key] = self.store.upsert(key, df)
        return [p for p in paths if p]

    @contextmanager
    def whole(self) -> Iterator[None]:
        """Commit what the body writes if it ends well; drop its scratch tables in any case."""
        try:
            yield
            self.counts = self.tally.collect()
            if self.next_states:
                self.store.commit(self.next_states)
                self.next_states = {}
        finally:
            delete_path(self.spark, self.scratch)


def salesforce_write(
    run: SyncRun, dynamic_contact_mapping: bool = False, order_by: str | None = None
) -> list[str]:
    """Accounts, then contacts and, with ``dynamic_contact_mapping``, leads.

    Of several rows with one id the last counts: by ``order_by``, or else by where it stands in
    parquet files.
    """
    if not run.by_connector:
        raise ValueError("no write mapping for this flow")
    with run.whole():
        return _salesforce_write(run, dynamic_contact_mapping, order_by)


def _salesforce_write(
    run: SyncRun, dynamic_contact_mapping: bool, order_by: str | None
) -> list[str]:
    paths: list[str] = []
    accounts = run.stream("accounts")
    if accounts is not None:
        result = salesforce.accounts_write(
            accounts, run.by_connector, run.id_map("Account"),
            run.state("Account.content", accounts, "id"), run.write_table,
        )
        paths += run.write(result)
    contacts = run.stream("contacts", with_line=True)
    if contacts is not None:
        maps = {s: run.id_map(s) for s in (CONTACT, LEAD)}
        states = {s: run.state(s) for s in (CONTACT, LEAD)}
        result = salesforce.contacts_write(
            contacts,
            run.by_connector,
            run.id_map(run.stream_names.get("accounts", "Account")),
            {s: m for s, m in maps.items() if m is not None},
            {s: m for s, m in states.items() if m is not None},
            dynamic_contact_mapping,
            order_by or (LINE if LINE in contacts.columns else None),
            materialise=run.write_table,
            watch=run.tally.watch,
        )
        paths += run.write(result)
    return paths


def hubspot_write(run: SyncRun) -> list[str]:
    """Accounts, contacts and unsubscribe requests."""
    if not run.by_target:
        raise ValueError("no write mapping for this flow")
    with run.whole():
        return _hubspot_write(run)


def _hubspot_write(run: SyncRun) -> list[str]:
    paths: list[str] = []
    accounts = run.stream("accounts")
    if accounts is not None and "accounts" in run.stream_names:
        name = run.stream_names["accounts"]
        key = EXTERNAL_ID if EXTERNAL_ID in accounts.columns else "id"
        result = hubspot.accounts_write(
            accounts, run.stream_names, run.id_map(name), run.state(f"{name}.content", accounts, key),
            run.write_table,
        )
        paths += run.write(result)
    contacts = run.stream("contacts")
    if contacts is not None:
        name = run.stream_names["contacts"]
        records = hubspot.contacts_write(contacts, run.id_map(name), materialise=run.write_table)
        paths.append(run.emit(name, records))
        requests = hubspot.unsubscribe_requests(contacts, run.tally.watch)
        paths.append(run.emit("unsubscribe_requests", requests))
    return [p for p in paths if p]


def marketo_write(run: SyncRun) -> list[str]:
    """Contacts as leads."""
    contacts = run.stream("contacts")
    if contacts is None:
        return []
    name = marketo.output_name(run.stream_names)
    with run.whole():
        sent = run.id_map(name)
        records = marketo.contacts_write(contacts, sent, materialise=run.write_table)
        path = run.emit(name, records)
    return [path] if path else []


def salesforce_read(run: SyncRun) -> list[str]:
    """Mapped objects as envelopes."""
    with run.whole():
        streams = {s: run.stream(s) for s in run.routes}
        streams = {s: df for s, df in streams.items() if df is not None}
        wrapped = salesforce.read(streams, run.routes, run.id_map("Account"), run.tally.watch)
        paths = [run.emit(s, df, json_columns=ENVELOPE_JSON) for s, df in wrapped.items()]
    return [p for p in paths if p]


def hubspot_read(run: SyncRun) -> list[str]:
    """Contacts and companies as envelopes; nothing for a flow without a mapping."""
    if not run.by_target:
        return []
    with run.whole():
        streams = {s: run.stream(s) for s in hubspot.READ_STREAMS}
        streams |= {s: run.stream(s, with_line=True) for s in ("owners", "lists")}
        streams = {s: df for s, df in streams.items() if df is not None}
        accounts = run.id_map("accounts", malformed="absent")
        wrapped = hubspot.read(
            streams, run.stream_names, accounts, run.write_table, run.tally.watch
        )
        paths = [run.emit(s, df, json_columns=ENVELOPE_JSON) for s, df in wrapped.items()]
    return [p for p in paths if p]


def marketo_read(run: SyncRun) -> list[str]:
    """Leads as envelopes; nothing for a flow without a mapping."""
    if not run.by_target:
        return []
    with run.whole():
        leads = run.stream(marketo.LEADS)
        if leads is None:
            return []
        name = hubspot.output_name(marketo.LEADS, run.stream_names)
        wrapped = marketo.read_stream(leads)
        options = {"json_columns": ENVELOPE_JSON} if wrapped.columns[0] == "data" else {}
        path = run.emit(name, wrapped, **options)
    return [path] if path else []


def passthrough_write(run: SyncRun, stream: str) -> str | None:
    """One stream as it is, under its mapped name."""
    with run.whole():
        df = run.stream(stream)
        name = run.stream_names.get(stream, stream)
        return None if df is None else run.emit(name, common.passthrough_write(df))


def mapped_write(run: SyncRun, stream: str) -> str | None:
    """One mapped stream without what was sent."""
    with run.whole():
        df = run.stream(stream)
        if df is None:
            return None
        name = run.stream_names[stream]
        records = common.mapped_write(
            df, stream, run.by_target, run.id_map(name), run.write_table
        )
        return run.emit(name, records)
