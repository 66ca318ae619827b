"""Counts of a run, taken while its records are written."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation

# Counts what passes through a frame under a label; with ``shuffled``, what will be shuffled.
Watch = Callable[..., DataFrame]


def unwatched(df: DataFrame, label: str, metrics: list[Column], shuffled: bool = False) -> DataFrame:
    """The ``Watch`` that counts nothing."""
    return df


class Counts:
    """Counts by label.

    Rows are counted in the tasks that write them, which a lost executor cannot make count
    twice. Ahead of a shuffle it could, as tasks there run again whose first run was counted;
    such rows are counted by a pass of their own over the columns that the counts need.
    """

    def __init__(self) -> None:
        self._taken: dict[str, dict[str, int]] = {}
        self._observed: dict[str, Observation] = {}

    def watch(
        self, df: DataFrame, label: str, metrics: list[Column], shuffled: bool = False
    ) -> DataFrame:
        """``df``, counted once it has been written; every frame watched has to be."""
        if shuffled:
            self._taken[label] = df.agg(*metrics).first().asDict()
            return df
        observation = Observation(f"{label}-{uuid.uuid4().hex}")
        self._observed[label] = observation
        return df.observe(observation, *metrics)

    def collect(self) -> dict[str, dict[str, int]]:
        """All counts; to be asked when the frames watched have been written."""
        return self._taken | {label: dict(o.get) for label, o in self._observed.items()}
