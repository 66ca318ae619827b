"""Marketo: contacts out as leads, and leads back."""

from __future__ import annotations

from pyspark.sql import DataFrame

from crmweave.functions.cleaning import sanitize_record
from crmweave.operators.dedupe import drop_sent
from crmweave.operators.envelope import wrap_envelope
from crmweave.operators.mapping import MARKETO_LEAD_READ_ONLY, drop_read_only
from crmweave.session import Materialise, stay_lazy

SOURCE = "MARKETO"
LEADS = "leads"


def contacts_write(
    contacts: DataFrame,
    sent: DataFrame | None,
    changed: DataFrame | None = None,
    materialise: Materialise = stay_lazy,
) -> DataFrame:
    """Contacts not sent yet, without read-only columns; no field mapping is needed."""
    writable = drop_read_only(contacts, MARKETO_LEAD_READ_ONLY)
    return sanitize_record(drop_sent(writable, sent, changed, materialise))


def output_name(stream_names: dict[str, str]) -> str:
    return stream_names.get("contacts", LEADS)


def read_stream(leads: DataFrame) -> DataFrame:
    """Leads as envelopes; without id or email column the rows pass unwrapped."""
    if {"id", "email"} - set(leads.columns):
        return sanitize_record(leads)
    return wrap_envelope(
        leads, SOURCE, LEADS, id_field="id", lookup_field="email",
        on_missing="passthrough", sanitize=True,
    )
