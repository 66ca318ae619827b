"""What a plan hands to a job."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

FieldMaps = dict[str, dict[str, str]]


@dataclass
class WriteResult:
    """Cleaned records by output stream, and the next version of each snapshot by name.

    ``changes`` has the rows, one per key, by which a snapshot's next version differs from the
    last; a store that holds the last one needs only those.
    """

    records: dict[str, DataFrame] = field(default_factory=dict)
    state: dict[str, DataFrame] = field(default_factory=dict)
    changes: dict[str, DataFrame] = field(default_factory=dict)
