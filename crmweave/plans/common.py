"""Steps that several CRMs share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from crmweave.functions.cleaning import sanitize_record
from crmweave.operators.dedupe import detect_changed, drop_sent, upsert_snapshot
from crmweave.operators.mapping import external_id_guard, map_stream
from crmweave.plans.result import FieldMaps, WriteResult
from crmweave.session import Materialise, stay_lazy


def write_if_new_or_changed(
    df: DataFrame,
    stream: str,
    sent: DataFrame | None,
    stored: DataFrame | None,
    materialise: Materialise = stay_lazy,
) -> WriteResult:
    """Records that were never sent or whose content changed, and the content state after it."""
    df = external_id_guard(df)
    changed = materialise(detect_changed(df, stored), f"{stream}.changed")
    return WriteResult(
        {stream: sanitize_record(drop_sent(df, sent, changed, materialise))},
        {f"{stream}.content": upsert_snapshot(stored, changed, unique=True)},
        {f"{stream}.content": changed},
    )


def passthrough_write(df: DataFrame) -> DataFrame:
    """A stream as it is, cleaned."""
    return sanitize_record(df)


def mapped_write(
    df: DataFrame,
    stream: str,
    mapping: FieldMaps,
    sent: DataFrame | None,
    materialise: Materialise = stay_lazy,
) -> DataFrame:
    """A mapped stream without the records already sent."""
    mapped = map_stream(df, stream, mapping)
    return sanitize_record(drop_sent(mapped, sent, materialise=materialise))
