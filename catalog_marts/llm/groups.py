"""Whole groups of rows, one after the other, from the sorted rows of a partition."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def clustered(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """All rows of a key in one partition, next to each other."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str], rows: int = 0
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that never cut a group, with the bounds of their groups; rows must be clustered.

    A table has at least ``rows`` rows, if there are as many.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = int(_starts(batch, keys)[-1])
        cut = last > 0 or (held and not _same(held[-1], batch, keys))
        if cut and sum(x.num_rows for x in held) + last >= max(rows, 1):
            yield _bounded(pa.Table.from_batches([*held, batch.slice(0, last)]), keys)
            held, batch = [], batch.slice(last)
        held.append(batch)
    if held:
        yield _bounded(pa.Table.from_batches(held), keys)


def _column(batch, key) -> np.ndarray:
    return batch.column(key).to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) else batch.column(key).to_numpy()


def _starts(batch, keys) -> np.ndarray:
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for key in keys:
        values = _column(batch, key)
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _same(left: pa.RecordBatch, right: pa.RecordBatch, keys) -> bool:
    return all(left.column(k)[left.num_rows - 1].as_py() == right.column(k)[0].as_py() for k in keys)


def _bounded(table: pa.Table, keys) -> tuple[pa.Table, np.ndarray]:
    table = table.combine_chunks()
    return table, np.append(_starts(table, keys), table.num_rows)
