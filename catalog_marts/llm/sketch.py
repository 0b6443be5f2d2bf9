"""Tables of fixed size, indexed by hash, that are filled by all tasks and read by all tasks.

A table has ``2 ** bits`` bytes whatever the number of rows, so it may be broadcast. Entries that
share a place add up: a count read from a table is never too low, except for rounding of large
counts, which goes up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from catalog_marts.llm.groups import clustered, whole_groups

_BLOCK_BITS = 16
_EXACT = 128  # counts below are exact, above them four steps per power of two


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def coded(counts: np.ndarray) -> np.ndarray:
    large = np.ceil(4 * np.log2(np.maximum(counts, _EXACT) / _EXACT)) + _EXACT
    return np.where(counts < _EXACT, counts, np.minimum(large, 255)).astype(np.uint8)


def decoded(codes: np.ndarray) -> np.ndarray:
    codes = codes.astype(np.float64)
    return np.where(codes < _EXACT, codes, _EXACT * 2 ** ((codes - _EXACT) / 4))


class Tally:
    """Counts of one task."""

    FIELDS = "block long, at binary, n binary"
    SCHEMA = pa.schema([("block", pa.int64()), ("at", pa.binary()), ("n", pa.binary())])

    def __init__(self, bits: int):
        self.counts = np.zeros(1 << bits, np.uint32)

    def add(self, place: np.ndarray, n: np.ndarray | None = None) -> None:
        if n is None:
            np.add.at(self.counts, place, np.uint32(1))
            return
        place, inverse = np.unique(place.astype(np.int32), return_inverse=True)
        n = np.bincount(inverse, n, len(place))
        self.counts[place] += n.astype(np.uint32)

    def batches(self) -> Iterator[pa.RecordBatch]:
        """The places counted, in blocks: positions in the block, and coded counts."""
        size = min(len(self.counts), 1 << _BLOCK_BITS)
        for block, counts in enumerate(self.counts.reshape(-1, size)):
            at = np.flatnonzero(counts)
            if len(at):
                row = [block], [at.astype("<u2").tobytes()], [coded(counts[at]).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, self.SCHEMA.types, strict=True)], self.SCHEMA.names)


def build_table(blocks: DataFrame, bits: int) -> np.ndarray:
    """Coded counts from the tallies of all tasks; the driver receives the finished table alone."""
    size = min(1 << bits, 1 << _BLOCK_BITS)

    def summed(batches):
        for table, bounds in whole_groups(batches, ["block"]):
            numbers, sums = [], []
            for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                total = np.zeros(size)
                for row in range(low, high):
                    at = np.frombuffer(table["at"][row].as_buffer(), "<u2")
                    total[at] += decoded(np.frombuffer(table["n"][row].as_buffer(), np.uint8))
                numbers.append(table["block"][low].as_py())
                sums.append(coded(total).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(sums, pa.binary())], ["block", "bytes"])

    result = np.zeros(((1 << bits) // size, size), np.uint8)
    rows = clustered(blocks.select("block", "at", "n"), ["block"])
    rows = rows.mapInArrow(summed, "block long, bytes binary").toArrow()
    for block, data in zip(rows["block"].to_pylist(), rows["bytes"], strict=True):
        result[block] = np.frombuffer(data.as_buffer(), np.uint8)
    return result.ravel()
