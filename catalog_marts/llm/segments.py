"""Texts cut at spaces, so that equal parts of many texts need to be looked at once only."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class Segments(NamedTuple):
    """Parts of text ``i`` are ``distinct[k]`` for ``k`` in ``index[bounds[i]:bounds[i + 1]]``."""

    distinct: pa.Array
    index: np.ndarray
    bounds: np.ndarray


def large_strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Texts from the bytes and offsets of :func:`catalog_marts.llm.text.utf8`, as an array that
    begins at the first byte (some functions misread large strings that do not).
    """
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, buffers)


def cut_at_spaces(data: np.ndarray, offsets: np.ndarray) -> Segments:
    """An empty text has one empty part, as ``str.split(" ")`` has."""
    parts = pc.split_pattern(large_strings(data, offsets), " ")
    coded = parts.flatten().dictionary_encode()
    return Segments(coded.dictionary, coded.indices.to_numpy(), parts.offsets.to_numpy().astype(np.int64))


def gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i], starts[i] + 1, ...``, ``lengths[i]`` of them, for all ``i`` in turn."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - ends + lengths, lengths) + np.arange(total)
