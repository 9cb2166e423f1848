"""Groups of sorted rows as they stream through a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Tables that hold whole groups of rows sorted by the keys."""
    rest: pa.Table | None = None
    for batch in batches:
        rest = pa.concat_tables([rest, pa.Table.from_batches([batch])]) if rest else pa.Table.from_batches([batch])
        if not rest.num_rows:
            continue
        starts = group_starts(rest, keys)
        if starts[-1] > 0:
            yield rest.slice(0, starts[-1])
            rest = rest.slice(starts[-1])
    if rest is not None and rest.num_rows:
        yield rest


def group_starts(table: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    """Where each group of equal keys begins."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for key in keys:
        values = table.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)
