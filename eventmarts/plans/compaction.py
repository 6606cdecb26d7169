"""Physical deduplication of an append-only table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame

from eventmarts.operators.dedup import latest_per_key
from eventmarts.sources.cursors import CursorTable
from eventmarts.sources.tables import write_unit


def compact(
    rows: DataFrame,
    root: str,
    state: CursorTable,
    now: datetime,
    version: Sequence[str],
    partition_by: Sequence[str] = (),
) -> str:
    """Write the latest row per key as the next numbered generation and make it current.

    Readers keep the generation they started with; the switch is one saved number, made after
    the data is complete.  Generations are ordered by their number, not by the callers' clocks.  Deduplication is over the whole table, so a record whose versions
    lie in different day folders keeps one row.
    """
    generation = (state.highest(root) or 0) + 1
    write_unit(latest_per_key(rows, version), root, "generation", str(generation), partition_by)
    state.save(root, generation, now)
    return f"{root}/generation={generation}"


def current_generation(root: str, state: CursorTable) -> str | None:
    """Folder of the current generation, or None before the first compaction."""
    generation = state.highest(root)
    return None if generation is None else f"{root}/generation={generation}"
