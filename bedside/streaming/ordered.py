"""Rows of a stream put in order before an ordered state machine sees them."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd

ORDER = ["t", "seq"]


def due(pending: dict[str, list], batches: Iterable[pd.DataFrame], watermark_ms: int) -> tuple[pd.DataFrame, dict[str, list]]:
    """Rows that the watermark has passed, in order, and those that still wait.

    A row inside the promised lateness may come after younger ones, so rows wait
    in the state until nothing older can come.  ``pending`` has the waiting rows
    by column; rows of one instant keep the order of ``seq`` (arrival without one).
    """
    columns = list(pending)
    frames = [pd.DataFrame(pending)]
    for pdf in batches:
        if "seq" in columns and "seq" not in pdf:
            pdf = pdf.assign(seq=0)
        frames.append(pdf[columns])
    rows = pd.concat([f for f in frames if len(f)] or frames[:1], ignore_index=True)
    rows = rows.sort_values(ORDER, kind="stable", ignore_index=True)
    past = rows["t"] * 1000.0 <= watermark_ms
    waiting = rows[~past]
    return rows[past], {c: waiting[c].tolist() for c in columns}


def wake_at(pending: dict[str, list], last: float, silence_ms: int, watermark_ms: int) -> int:
    """When a series is due next: at its first waiting row, else after its silence."""
    at = pending["t"][0] * 1000.0 if pending["t"] else max(last * 1000.0, watermark_ms) + silence_ms
    return max(int(at), watermark_ms) + 1
