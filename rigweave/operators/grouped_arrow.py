"""Streaming over sorted Arrow batches: whole groups at a time, in bounded memory."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa


def boundaries(table: pa.Table | pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """True at each row whose key differs from the row before it."""
    n = table.num_rows
    new = np.zeros(n, dtype=bool)
    if n:
        new[0] = True
    for key in keys:
        column = table.column(key)
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if pa.types.is_integer(column.type) and column.null_count == 0:
            values = column.to_numpy(zero_copy_only=False)
        else:
            column = column.dictionary_encode() if not pa.types.is_dictionary(column.type) else column
            values = column.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    return new


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 65536) -> Iterator[pa.Table]:
    """Regroup batches sorted by `keys` into tables that end at a group's end and hold about `rows` rows.

    At most one chunk and the unfinished group are held at a time.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        last = int(np.flatnonzero(boundaries(table, keys))[-1])
        if last:
            yield table.slice(0, last)
            table = table.slice(last)
        held = table.combine_chunks().to_batches()
        size = table.num_rows
        rows = max(rows, 2 * size) if not last else rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def grouped(keys: list[str], work: Callable[[pa.Table], Iterator[pa.RecordBatch]], rows: int = 65536):
    """A mapInArrow function that hands `work` tables of whole groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys, rows):
            yield from work(table)

    return run
