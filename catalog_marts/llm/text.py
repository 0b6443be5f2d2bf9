"""Words of whole texts as 64-bit hashes, computed a block of bytes at a time in numpy.

A word is a longest run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. All of these are single bytes in UTF-8, so words never cut a character.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The same words as a pattern, for SQL and for tests.
WORD = r"[^\x20\x09-\x0D]+"

BLOCK = 1 << 20  # bytes hashed at a time; bounds the working arrays, not the results

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
PUNCTUATION = np.ones(256, bool)  # ASCII apart from letters and digits
PUNCTUATION[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Words(NamedTuple):
    """Hash and byte range of every word; words of text ``i`` are ``bounds[i]:bounds[i + 1]``."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits; a bijection of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column, one after the other, and where each begins and ends."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _blocks(data: np.ndarray, breaks: np.ndarray, block: int) -> Iterator[tuple[int, int]]:
    """Cuts after a break, so that no word lies in two blocks."""
    low = 0
    while low < len(data):
        high = min(low + block, len(data))
        while high < len(data):
            spaces = np.flatnonzero(breaks[data[max(low, high - block) : high]])
            if len(spaces):
                high = max(low, high - block) + int(spaces[-1]) + 1
                break
            high = min(high + block, len(data))
        yield low, high
        low = high


def hash_words(
    data: np.ndarray,
    offsets: np.ndarray,
    lower: bool = False,
    breaks: np.ndarray = SPACE,
    block: int = BLOCK,
) -> Words:
    """Words of the texts that :func:`utf8` returns. ``lower`` maps A-Z to a-z first; ``breaks``
    marks the bytes between words.

    The hash takes eight bytes of a word at a time, mixing after each step, and the word's
    length; equal words have equal hashes.
    """
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    plain = breaks is SPACE
    hashes, starts, ends = [], [], []
    for low, high in _blocks(data, breaks, block):
        part = np.zeros(high - low + 8, np.uint8)  # eight bytes can be read at every position
        body = part[: high - low]
        body[:] = data[low:high]
        if lower:
            body += ((body - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5)
        if plain:
            word = ~((body == 32) | ((body - np.uint8(9)) < 5))
        else:
            word = ~breaks[body]
        begins = word.copy()
        begins[1:] &= ~word[:-1] | first[low + 1 : high]
        word[:-1] &= ~word[1:] | first[low + 1 : high]
        start, end = np.flatnonzero(begins), np.flatnonzero(word) + 1
        if not len(start):
            continue
        eight = np.lib.stride_tricks.as_strided(part[:8].view("<u8"), (high - low + 1,), (1,))
        length = end - start
        value = mix((eight[start] & _MASKS[np.minimum(length, 8)]) + length.astype(np.uint64) * _STEP)
        rest, at = np.flatnonzero(length > 8), 8
        while len(rest):
            value[rest] = mix(value[rest] * _STEP + (eight[start[rest] + at] & _MASKS[np.minimum(length[rest] - at, 8)]))
            at += 8
            rest = rest[length[rest] > at]
        hashes.append(value)
        starts.append(start + low)
        ends.append(end + low)
    if not hashes:
        none = np.empty(0, np.int64)
        return Words(none.astype(np.uint64), none, none, np.zeros(len(offsets), np.int64))
    starts = np.concatenate(starts)
    return Words(np.concatenate(hashes), starts, np.concatenate(ends), np.searchsorted(starts, offsets))


def pieces(batch: pa.RecordBatch, text: str = "text", limit: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``limit`` bytes of text, at least one row each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    low, held = 0, 0
    for i, size in enumerate(sizes):
        if i > low and held + size > limit:
            yield batch.slice(low, i - low)
            low, held = i, 0
        held += int(size)
    if low < len(sizes):
        yield batch.slice(low)
