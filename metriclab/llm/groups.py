"""Groups of consecutive rows of sorted Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def by_key(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with the bounds of the groups in each; rows must be sorted by ``keys``."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
        bounds = _bounds(table, keys)
        if len(bounds) > 2:
            yield table.slice(0, bounds[-2]), bounds[:-1]
        rest = table.slice(bounds[-2])
    if rest is not None and rest.num_rows:
        yield rest, _bounds(rest, keys)


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    n = table.num_rows
    change = np.zeros(n, dtype=bool)
    change[0] = True
    for key in keys:
        column = table.column(key)
        differ = pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, n - 1)), True)
        change[1:] |= np.asarray(differ.combine_chunks() if isinstance(differ, pa.ChunkedArray) else differ).astype(bool)
    return np.append(np.flatnonzero(change), n)
