"""Whole groups out of a sorted stream of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold whole groups of the first `keys` columns, and the bounds of their groups.

    The input is in order of those columns. The rows of a batch's last group wait for the next batch.
    """
    held: list[pa.RecordBatch] = []

    def made() -> tuple[pa.Table, np.ndarray]:
        table = pa.Table.from_batches(held).combine_chunks()
        ids = np.stack([table.column(c).to_numpy() for c in range(keys)], axis=1)
        return table, np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]).any(axis=1), [True]]))

    for batch in batches:
        if not batch.num_rows:
            continue
        same = np.ones(batch.num_rows, dtype=bool)
        for c in range(keys):
            column = batch.column(c).to_numpy()
            same &= column == column[-1]
        other = np.flatnonzero(~same)
        end = int(other[-1]) + 1 if len(other) else 0
        if end or held and any(held[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in range(keys)):
            if end:
                held.append(batch.slice(0, end))
            yield made()
            held = []
        held.append(batch.slice(end))
    if held:
        yield made()
