"""Removing repeated lines by an exact set-similarity join.

A line is the set of its lower-cased words. Words are ordered by rarity, one order for all lines,
so two similar lines share a word among the first few of each: their prefixes. Lines meet at the
words of their prefixes; pairs whose lengths, positions of the shared word, or word bitmaps rule
the similarity out are dropped, the rest is confirmed on the full sets. A line goes if a line
before it is similar enough, so one confirmed earlier line is all that it takes: each line first
tries its closest candidate. Lines without success then meet the others again, with full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_marts.llm.groups import whole_groups
from catalog_marts.llm.held import release, tidied
from catalog_marts.llm.segments import gathered
from catalog_marts.llm.sketch import Tally, build_table, decoded, places
from catalog_marts.llm.text import hash_words, mix, pieces, utf8
from catalog_marts.sources import scratch_copy

BITS = 24  # of the table of word counts: 16 MB
PACK = 4 << 20  # bytes of text whose postings are packed together
PAIRS = 16384  # of lines, looked at together at least
MARK_BITS = 24  # of the tables that mark lines and words to look at again: 16 MB


class Tuning(NamedTuple):
    """What work is done first; results are the same with all values."""

    chunk: int = 5_000_000  # lines with a word from which those it is a prefix of are met in parts
    wide: int = 96  # words from which a line has a second, wider bitmap
    likely: float = 0.15  # up to this share of the allowed bitmap distance, and with so many words
    long: int = 24  # or more, a candidate is similar almost surely and ends a line's search
    tries: int = 64  # if the line has had so many candidates


_LINE = ["doc", "line", "hash"]
_LINE_TYPE = "doc long, line int, hash long"


class Lines(NamedTuple):
    """Lines with words, and their distinct words: of line ``i``, ``bounds[i]:bounds[i + 1]``."""

    doc: np.ndarray
    line: np.ndarray
    hash: np.ndarray  # of the set of words
    words: np.ndarray
    bounds: np.ndarray
    text: np.ndarray  # number of the row in the batch


_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mark(doc: np.ndarray, line: np.ndarray, bits: int) -> np.ndarray:
    return places(mix(mix(doc.astype(np.uint64)) + line.astype(np.uint64) * _STEP), bits)


def _line_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where lines begin, the texts that they are in, and their numbers in these."""
    begins = np.union1d(np.flatnonzero(data == 10) + 1, offsets[:-1])
    begins = begins[begins < len(data)]
    text = np.searchsorted(offsets, begins, side="right") - 1
    return begins, text, np.arange(len(begins)) - np.searchsorted(begins, offsets)[text]


def _with_marks(part: pa.RecordBatch, marked: np.ndarray) -> pa.RecordBatch:
    """The rows that have a marked line."""
    _, text, number = _line_starts(*utf8(part.column("text")))
    hit = marked[_mark(part.column("doc").to_numpy()[text], number, MARK_BITS)] > 0
    return part.take(pa.array(np.unique(text[hit])))


def split_lines(part: pa.RecordBatch, order: np.ndarray | None = None, marked: np.ndarray | None = None) -> Lines:
    """Distinct words of each line of a batch of ``doc`` and ``text``, by hash or by rarity.

    ``order`` is the table of word counts. With ``marked`` only lines marked there are looked at.
    """
    docs = part.column("doc").to_numpy()
    data, offsets = utf8(part.column("text"))
    begins, text, number = _line_starts(data, offsets)
    words = hash_words(data, offsets, lower=True)
    of_word = np.repeat(np.arange(len(begins)), np.diff(np.searchsorted(words.starts, begins), append=len(words.starts)))
    hashes = words.hashes
    if marked is not None:
        keep = marked[_mark(docs[text], number, MARK_BITS)][of_word] > 0
        of_word, hashes = of_word[keep], hashes[keep]
    key = of_word.astype(np.uint64) << np.uint64(40)
    if order is None:
        key |= hashes >> np.uint64(24)
    else:
        key |= (order[places(hashes, BITS)].astype(np.uint64) << np.uint64(32)) | (hashes >> np.uint64(32))
    by = np.argsort(key) if len(begins) < 1 << 24 else np.lexsort((key << np.uint64(24), of_word))
    of_word, hashes = of_word[by], hashes[by]
    new = np.ones(len(by), bool)
    new[1:] = (of_word[1:] != of_word[:-1]) | (hashes[1:] != hashes[:-1])
    of_word, hashes = of_word[new], hashes[new]
    bounds = np.flatnonzero(np.append(True, of_word[1:] != of_word[:-1])) if len(of_word) else np.empty(0, np.int64)
    lines = of_word[bounds]
    whole = np.add.reduceat(mix(hashes), bounds) if len(bounds) else np.empty(0, np.uint64)
    return Lines(docs[text[lines]], number[lines], mix(whole), hashes, np.append(bounds, len(hashes)), text[lines])


def _least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """Words that two lines with ``n`` words together must share."""
    return -(-percent * n // (100 + percent))


def _in_order(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Numbers in the order of the lines, equal for the same line."""
    if len(doc) and doc.min() >= 0 and doc.max() < 1 << 39 and line.max() < 1 << 24:
        return doc << 24 | line
    by = np.lexsort((line, doc))
    new = np.append(True, (doc[by][1:] != doc[by][:-1]) | (line[by][1:] != line[by][:-1]))[: len(by)]
    number = np.empty(len(by), np.int64)
    number[by] = np.cumsum(new)
    return number


def _reach(group: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """How many rows before each one are of its group and not too short for it, by group and length."""
    rows = np.arange(len(n))
    new = np.append(True, group[1:] != group[:-1])[: len(n)]
    size = int(n.max()) + 1 if len(n) else 1
    number = np.cumsum(new) - 1
    return rows - np.searchsorted(number * size + n, number * size + -(-percent * n // 100))


def _pairs(reach: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows with the ones before them that they reach, the nearest first, many pairs at a time."""
    low, back = np.arange(len(reach)), 1
    while len(low := low[reach[low] >= back]):
        backs = np.arange(back, min(back + max(PAIRS // len(low), 1), int(reach[low].max()) + 1))
        y, apart = np.tile(low, len(backs)), np.repeat(backs, len(low))
        if len(backs) > 1:
            near = apart <= reach[y]
            y, apart = y[near], apart[near]
        yield y, y - apart
        back += len(backs)


def _batches(batches: Iterator[pa.RecordBatch], *tables) -> Iterator[Lines]:
    for batch in batches:
        for part in pieces(batch, "text"):
            yield split_lines(part, *tables)


_SURVEY = pa.schema([("doc", pa.int64()), ("line", pa.int32()), ("hash", pa.int64()), ("again", pa.bool_()), *Tally.SCHEMA])


@tidied
def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every line's hash, and whether its text has an equal line before it; at the end of a task,
    in how many lines the words are.
    """
    def filled(batch):
        names = batch.schema.names
        return pa.RecordBatch.from_arrays(
            [batch.column(f.name) if f.name in names else pa.nulls(len(batch), f.type) for f in _SURVEY], schema=_SURVEY
        )

    release()
    tally = Tally(BITS)
    for lines in _batches(batches):
        tally.add(places(lines.words, BITS))
        by = np.lexsort((lines.line, lines.hash, lines.text))
        again = np.zeros(len(by), bool)
        again[by[1:]] = (lines.hash[by][1:] == lines.hash[by][:-1]) & (lines.text[by][1:] == lines.text[by][:-1])
        yield filled(pa.RecordBatch.from_arrays(
            [pa.array(lines.doc), pa.array(lines.line.astype(np.int32)), pa.array(lines.hash.view(np.int64)), pa.array(again)], [*_LINE, "again"]
        ))
    yield from map(filled, tally.batches())


#: One line at one of its prefix words. Many of them travel as one value, column by column, each
#: column in the smallest type that holds its values above the least one.
_POSTING = ["word", "chunk", "chunks", "n", "at", "bits", "bits2", "asks", "doc", "line", "hash"]
_TYPES = ["<u1", "<u2", "<u4", "<u8"]


def _pack(columns: list[np.ndarray], bounds: np.ndarray, wide: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """A value for each range between bounds, with the wide bitmaps between its ends."""
    sizes = np.diff(bounds)
    parts = [[size.tobytes()] for size in sizes.astype("<u8")]
    for column in columns:
        least = np.minimum.reduceat(column, bounds[:-1])
        above = (column - np.repeat(least, sizes)).astype(np.uint64)
        kinds = np.searchsorted([np.iinfo(t).max for t in _TYPES[:-1]], np.maximum.reduceat(above, bounds[:-1]))
        typed = [above.astype(t) if (kinds == k).any() else above for k, t in enumerate(_TYPES)]
        for part, kind, low, a, b in zip(parts, kinds.tolist(), least, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            part += [kind.to_bytes(8, "little"), low.tobytes(), typed[kind][a:b].tobytes()]
    return [b"".join([*part, wide[a:b].astype("<u8").tobytes()]) for part, a, b in zip(parts, ends[:-1], ends[1:], strict=True)]


def _unpack(data: pa.Buffer) -> tuple[list[np.ndarray], np.ndarray]:
    rows, at, columns = int(np.frombuffer(data, "<u8", 1)[0]), 8, []
    for _ in _POSTING:
        kind = _TYPES[int(np.frombuffer(data, "<u8", 1, at)[0])]
        column = np.frombuffer(data, kind, rows, at + 16).astype(np.uint64) + np.frombuffer(data, "<u8", 1, at + 8)
        columns.append(column)
        at += 16 + rows * np.dtype(kind).itemsize
    return columns, np.frombuffer(data, "<u8", -1, at) if at < data.size else np.empty(0, np.uint64)


def _width(n: np.ndarray, least: int) -> np.ndarray:
    """64-bit words of the second bitmap: a power of two, none for short lines."""
    wide = 2 ** np.maximum(np.ceil(np.log2(np.maximum(n, least) / 48)), 0).astype(np.int64)
    return np.where(n > least, wide, 0)


def _apart(wide: np.ndarray, offset: np.ndarray, widths: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Differing bits of the second bitmaps of pairs of long lines; a wider one is folded."""
    result = np.zeros(len(y), np.int64)
    width_y, width_x = widths[y], widths[x]
    width = np.minimum(width_y, width_x)

    def bitmap(rows, own, size):
        at = offset[rows][:, None] + np.arange(size)
        folded = wide[at]
        for k in range(1, own // size):
            folded = folded | wide[at + k * size]
        return folded

    for size, of_y, of_x in {t for t in zip(width.tolist(), width_y.tolist(), width_x.tolist(), strict=True) if t[0]}:
        some = np.flatnonzero((width == size) & (width_y == of_y) & (width_x == of_x))
        for part in np.array_split(some, 1 + len(some) // 4096):
            differ = bitmap(y[part], of_y, size) ^ bitmap(x[part], of_x, size)
            result[part] = np.bitwise_count(differ).sum(1, dtype=np.int64)
    return result


@tidied
def _postings(
    batches: Iterator[pa.RecordBatch], table, percent: int, parts: int, tuning: Tuning, again=None
) -> Iterator[pa.RecordBatch]:
    """The prefix words of each line that other lines have, packed by the part they meet in.

    ``again``: marks of the lines that look for all candidates, and of their words.
    """
    release()
    table = table.value
    again = again and again.value
    for batch in (part for batch in batches for part in pieces(batch, "text", PACK)):
        lines = list(_batches([batch], table))
        keep = _first_of_equal(lines)
        found = [_line_postings(x, k, table, percent, tuning, again) for x, k in zip(lines, keep, strict=True)]
        if not sum(len(x["word"]) for x, _ in found):
            continue
        columns = [np.concatenate([x[c] for x, _ in found]) for c in _POSTING]
        widths = _width(columns[_POSTING.index("n")], tuning.wide)
        ends = np.append(0, np.cumsum(widths))
        wide = np.concatenate([w for _, w in found])
        part = (mix(columns[0] + columns[1].astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part = part[order]
        bounds = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
        wide = wide[gathered(ends[:-1][order], widths[order])]
        ends = np.append(0, np.cumsum(widths[order]))[bounds]
        packed = _pack([c[order] for c in columns], bounds, wide, ends)
        yield pa.RecordBatch.from_arrays([pa.array(part[bounds[:-1]]), pa.array(packed, pa.binary())], ["part", "postings"])


def _first_of_equal(lines: list[Lines]) -> list[np.ndarray]:
    """Marks of the lines of a batch to look at: equal lines meet everywhere, the first is enough."""
    sizes = [len(x.hash) for x in lines]
    hashes, docs, numbers = (np.concatenate([getattr(x, f) for x in lines] or [np.empty(0, np.int64)]) for f in ("hash", "doc", "line"))
    by = np.lexsort((numbers, docs, hashes))
    keep = np.zeros(len(by), bool)
    if len(by):
        keep[by[np.append(True, hashes[by][1:] != hashes[by][:-1])]] = True
    return np.split(keep, np.cumsum(sizes)[:-1]) if lines else []


def _line_postings(lines: Lines, keep: np.ndarray, table: np.ndarray, percent: int, tuning: Tuning, again) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Columns of postings, and the wide bitmaps of their lines."""
    bounds, words = lines.bounds, lines.words
    n = np.diff(bounds)
    of = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(words)) - bounds[of]
    chosen = np.flatnonzero((at <= (n - -(-percent * n // 100))[of]) & keep[of])
    count = table[places(words[chosen], BITS)]
    met = count > 1
    if again:
        met &= again[1][places(words[chosen], MARK_BITS)] > 0
    chosen, count = chosen[met], count[met]
    asks = np.ones(len(n), bool) if not again else again[0][_mark(lines.doc, lines.line, MARK_BITS)] > 0
    bit = np.uint64(1) << (words & np.uint64(63))
    odd = (words & np.uint64(64)) > 0
    bits = [np.bitwise_or.reduceat(np.where(odd == k, bit, np.uint64(0)), bounds[:-1]) if len(n) else bit for k in (0, 1)]
    line = of[chosen]
    chunks = np.maximum(np.ceil(decoded(count) / tuning.chunk), 1).astype(np.int64)
    chunk = (lines.hash[line] % chunks.astype(np.uint64)).astype(np.int64)

    width = _width(n, tuning.wide)
    start = np.append(0, np.cumsum(width))
    wide = np.zeros(start[-1], np.uint64)
    long = width[of] > 0
    place = start[of[long]] + ((words[long] >> np.uint64(6)) % width[of[long]].astype(np.uint64)).astype(np.int64)
    np.bitwise_or.at(wide, place, bit[long])
    own = width[line]
    wide = wide[np.repeat(start[line], own) + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)]
    return {
        "word": words[chosen] >> np.uint64(32), "chunk": chunk, "chunks": chunks, "n": n[line], "at": at[chosen],
        "bits": bits[0][line], "bits2": bits[1][line], "asks": asks[line].astype(np.int64), "doc": lines.doc[line],
        "line": lines.line[line], "hash": lines.hash[line] & np.uint64(0xFFFFFFFF),
    }, wide


def _each_part(table: pa.Table, bounds: np.ndarray) -> Iterator[pa.Table]:
    """The rows of one part after the other: unpacked they take ten times the memory."""
    return (table.slice(low, high - low) for low, high in zip(bounds[:-1], bounds[1:], strict=True))


def _unpacked(table: pa.Table) -> tuple[dict[str, np.ndarray], np.ndarray]:
    found = [_unpack(value.as_buffer()) for value in table["postings"].combine_chunks()]
    columns = [np.concatenate([f[0][k] for f in found]) for k in range(len(_POSTING))]
    columns = dict(zip(_POSTING, columns, strict=True))
    for c in ("chunk", "chunks", "n", "at", "asks", "doc", "line"):
        columns[c] = columns[c].view(np.int64)
    return columns, np.concatenate([f[1] for f in found])


_CANDIDATE = "doc long, line int, hash long, doc2 long, line2 int, hash2 long, apart double, others boolean, more boolean"


@tidied
def _candidates(batches: Iterator[pa.RecordBatch], percent: int, tuning: Tuning) -> Iterator[pa.RecordBatch]:
    """For each line the closest earlier line of its part that passes the filters.

    ``others`` tells that there are more, which come out as rows without a partner; ``more`` that
    the search ended early or that other chunks of a word may hold some.
    """
    for table, bounds in whole_groups(batches, ["part"]):
        found = [_closest_in_part(part, percent, tuning) for part in _each_part(table, bounds)]
        pairs = _closest([np.concatenate(c) for c in zip(*(f[0] for f in found), strict=True)])
        doc, line, hashes = (np.concatenate(c) for c in zip(*(f[1] for f in found), strict=True))
        some = np.unique(_in_order(doc, line), return_index=True)[1]
        none = pa.nulls(len(some), pa.int64())
        own = [pa.array(np.append(a, b[some])) for a, b in zip(pairs[:3], (doc, line, hashes), strict=True)]
        other = [pa.concat_arrays([pa.array(c), none]) for c in pairs[3:6]]
        rest = [pa.array(np.append(c, np.zeros(len(some), c.dtype))) for c in pairs[6:]]
        columns = [c.cast(t) for c, t in zip([*own, *other], 2 * (pa.int64(), pa.int32(), pa.int64()), strict=True)]
        yield pa.RecordBatch.from_arrays([*columns, *rest], [*_LINE, "doc2", "line2", "hash2", "apart", "others", "more"])


def _closest(rows: list[np.ndarray]) -> list[np.ndarray]:
    """One row of each line's candidates, the closest; the columns are those of ``_CANDIDATE``."""
    doc, line, _, doc2, line2, _, apart, others, more = rows
    own, other = _in_order(doc, line), _in_order(doc2, line2)
    by = np.lexsort((apart, own))
    low = np.flatnonzero(np.append(True, np.diff(own[by]) > 0)[: len(by)])
    if not len(low):
        return rows
    differ = other[by] != np.repeat(other[by][low], np.diff(low, append=len(by)))
    best = [c[by[low]] for c in rows[:7]]
    return [*best, np.logical_or.reduceat(others[by] | differ, low), np.logical_or.reduceat(more[by], low)]


class _Nearest:
    """The closest partner of each row, the first one of equals; pairs go as soon as they are seen.

    Of a line with many variants there are as many pairs as the square of their number.
    """

    def __init__(self, rows: int):
        self.share, self.partner, self.when, self.seen = np.full(rows, np.inf), np.zeros(rows, np.int64), np.zeros(rows, np.int64), 0

    def add(self, y: np.ndarray, x: np.ndarray, share: np.ndarray) -> None:
        closer = np.flatnonzero(share < self.share[y])
        np.minimum.at(self.share, y[closer], share[closer])
        best = closer[share[closer] == self.share[y[closer]]][::-1]  # the first one is stored last
        self.partner[y[best]], self.when[y[best]] = x[best], self.seen + best
        self.seen += len(y)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, partners and shares, in the order in which they were seen."""
        rows = np.flatnonzero(self.share < np.inf)
        rows = rows[np.argsort(self.when[rows])]
        return rows, self.partner[rows], self.share[rows]


def _closest_in_part(packed: pa.Table, percent: int, tuning: Tuning) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The closest candidates in a part, and the lines that a later step may need."""
    columns, wide = _unpacked(packed)
    widths = _width(columns["n"], tuning.wide)
    group = columns["word"] << np.uint64(32) | columns["chunk"].astype(np.uint64)
    where = _in_order(columns["doc"], columns["line"])
    if columns["chunk"].any() or columns["n"].max(initial=0) >> 32:
        by = np.lexsort((columns["n"], group))
    else:
        by = np.argsort(group | columns["n"].astype(np.uint64))
    offset, widths = (np.cumsum(widths) - widths)[by], widths[by]
    columns, group, where = {c: v[by] for c, v in columns.items()}, group[by], where[by]
    n, at, bits, bits2, hashes = (columns[c] for c in ("n", "at", "bits", "bits2", "hash"))
    asks = columns["asks"] > 0
    tried, closed, stopped = np.zeros(len(by), np.int64), ~asks, np.zeros(len(by), bool)
    # pairs of rows of a group whose lengths agree: a row and the ones before it, by length
    margin = np.arange(2 * int(n.max()) + 1 if len(n) else 1)
    margin = (margin - 2 * _least_overlap(margin, percent)).astype(np.int32)  # by words of both
    short = n.astype(np.int32)
    nearest, needed = _Nearest(len(by)), np.zeros(len(by), bool)
    for y, x in _pairs(_reach(group, n, percent)):
        if 2 * np.count_nonzero(closed) > len(closed):
            some = np.flatnonzero(~(closed[y] & closed[x]))
            y, x = y[some], x[some]
        apart = np.bitwise_count(bits[y] ^ bits[x]) + np.bitwise_count(bits2[y] ^ bits2[x])
        allowed = margin[short[y] + short[x]]
        some = np.flatnonzero(apart <= allowed)
        y, x, apart, allowed = y[some], x[some], apart[some].astype(np.int64), allowed[some].astype(np.int64)
        late = where[x] > where[y]
        y, x = np.where(late, x, y), np.where(late, y, x)  # the later line asks
        some = ~closed[y]
        y, x, apart, allowed = y[some], x[some], apart[some], allowed[some]
        least = _least_overlap(n[y] + n[x], percent)
        some = np.minimum(at[y], at[x]) + np.minimum(n[y] - at[y], n[x] - at[x]) >= least
        y, x, apart, allowed = y[some], x[some], apart[some], allowed[some]
        if len(y) and (np.minimum(n[y], n[x]) > tuning.wide).any():
            apart = np.maximum(apart, _apart(wide, offset, widths, y, x))
            some = apart <= allowed
            y, x, apart, allowed = y[some], x[some], apart[some], allowed[some]
        # an earlier line with the same words: this one goes by that rule alone
        equal = (hashes[y] == hashes[x]) & (apart == 0) & (n[y] == n[x])
        nearest.add(y[~equal], x[~equal], (apart / np.maximum(allowed, 1))[~equal])
        needed[x[~equal]] = True
        closed[y[equal]] = True
        np.add.at(tried, y, 1)
        strong = (apart <= tuning.likely * allowed) & (np.minimum(n[y], n[x]) >= tuning.long) & ~equal
        enough = y[strong & (tried[y] >= tuning.tries)]
        closed[enough] = stopped[enough] = True
    y, x, share = nearest.pairs()
    more = stopped | (columns["chunks"] > 1)
    lone = np.flatnonzero(asks & (columns["chunks"] > 1) & (tried == 0))
    y, x, share = np.append(y, lone), np.append(x, lone), np.append(share, np.full(len(lone), 9.0))
    needed[lone] = needed[y[tried[y] > 1]] = True
    some = np.flatnonzero(needed)
    some = some[np.unique(where[some], return_index=True)[1]]
    lines = [columns[c].astype(np.int64) for c in _LINE]
    pairs = _closest([*(c[y] for c in lines), *(c[x] for c in lines), share, tried[y] > 1, more[y]])
    return pairs, [c[some] for c in lines]


_MEETING = "part long, lines binary"


@tidied
def _meetings(
    batches: Iterator[pa.RecordBatch], table, percent: int, parts: int, tuning: Tuning, asked
) -> Iterator[pa.RecordBatch]:
    """Lines with full sets at each of their prefix words that asking lines have, packed by part.

    The lines of a word with several chunks meet in blocks of two chunks, sides 0 and 1, and of
    one, side 2, each of them a part of its own.
    """
    table, asked = table.value, asked.value
    for batch in batches:
        lists = batch.column("words")
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        words = lists.flatten().to_numpy().view(np.uint64)
        n = np.diff(bounds)
        of = np.repeat(np.arange(len(n)), n)
        by = np.lexsort((words >> np.uint64(32), table[places(words, BITS)], of))
        at = np.arange(len(words)) - bounds[of]
        chosen = np.flatnonzero((at <= (n - -(-percent * n // 100))[of]) & (asked[places(words[by], MARK_BITS)] > 0))
        word, line = words[by][chosen], of[chosen]
        chunks = np.maximum(np.ceil(decoded(table[places(word, BITS)]) / tuning.chunk), 1).astype(np.int64)
        asks = batch.column("asks").to_numpy(zero_copy_only=False)
        doc, number, hashes = (batch.column(c).to_numpy().astype(np.int64) for c in _LINE)
        other = np.arange(chunks.sum()) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        line, word, chunks = (np.repeat(v, chunks) for v in (line, word, chunks))
        own = hashes[line] % chunks
        chunk = np.minimum(own, other) * chunks + np.maximum(own, other)
        side = np.where(own == other, 2, own > other)
        spot = mix(mix(word) + chunk.astype(np.uint64))
        part = np.where(chunks > 1, parts + (spot >> np.uint64(2)).astype(np.int64), (spot % np.uint64(parts)).astype(np.int64))
        order = np.argsort(part, kind="stable")
        part, line, word, chunk, side = part[order], line[order], word[order], chunk[order], side[order]
        low = np.flatnonzero(np.append(True, part[1:] != part[:-1])[: len(part)])
        packed = []
        for a, b in zip(low, np.append(low[1:], len(part)), strict=False):
            rows = line[a:b]
            head = np.stack([word[a:b].view(np.int64), chunk[a:b], doc[rows], number[rows], hashes[rows], asks[rows].astype(np.int64), n[rows], side[a:b]])
            sets = np.concatenate([words[bounds[r] : bounds[r + 1]] for r in rows])
            packed.append(np.array([b - a], np.int64).tobytes() + head.astype(np.int64).tobytes() + sets.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(part[low]), pa.array(packed, pa.binary())], ["part", "lines"])


_AT_ONCE = 500_000  # words of pairs compared at a time


def _common(words: np.ndarray, size: int, begin: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words, numbers below ``size``, the sets of each pair share: keys of both that occur twice."""
    keys = [np.repeat(np.arange(len(r)), n[r]) * size + words[gathered(begin[r], n[r])] for r in (a, b)]
    keys = np.sort(np.concatenate(keys))
    return np.bincount(keys[1:][keys[1:] == keys[:-1]] // size, minlength=len(a))


@tidied
def _met(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The asking lines that a line before them in their group is similar to."""
    for table in (part for found in whole_groups(batches, ["part"]) for part in _each_part(*found)):
        heads, sets = [], []
        for value in table["lines"].combine_chunks():
            data = value.as_buffer()
            rows = int(np.frombuffer(data, np.int64, 1)[0])
            heads.append(np.frombuffer(data, np.int64, 8 * rows, 8).reshape(8, rows))
            sets.append(np.frombuffer(data, np.uint64, -1, 8 + 64 * rows))
        head, words = np.concatenate(heads, axis=1), np.concatenate(sets)
        words = pa.array(words).dictionary_encode()  # small numbers, for keys of pair and word
        size, words = len(words.dictionary), words.indices.to_numpy().astype(np.int64)
        begin = np.cumsum(head[6]) - head[6]
        bit = np.uint64(1) << (words & 63).astype(np.uint64)
        bits = [np.bitwise_or.reduceat(np.where((words >> 6) & 1 == k, bit, np.uint64(0)), begin) for k in (0, 1)]
        by = np.lexsort((head[4], head[3], head[2], head[6], head[1], head[0]))
        head, begin, bits, bits2 = head[:, by], begin[by], bits[0][by], bits[1][by]
        n, asks, found = head[6], head[5] > 0, np.zeros(len(by), bool)
        new = np.append(True, (head[:2, 1:] != head[:2, :-1]).any(0))
        for y, x in _pairs(_reach(np.cumsum(new), n, percent)):
            total = n[y] + n[x]  # words in one set only set other bits, or the same ones
            apart = np.bitwise_count(bits[y] ^ bits[x]) + np.bitwise_count(bits2[y] ^ bits2[x])
            some = np.flatnonzero(apart <= total - 2 * _least_overlap(total, percent))
            y, x = y[some], x[some]
            late = (head[2][x] > head[2][y]) | ((head[2][x] == head[2][y]) & (head[3][x] > head[3][y]))
            y, x = np.where(late, x, y), np.where(late, y, x)
            different = (head[2][x] != head[2][y]) | (head[3][x] != head[3][y])
            apart = (head[7][x] != head[7][y]) | (head[7][y] == 2)
            some = np.flatnonzero(asks[y] & ~found[y] & different & apart)
            for part in np.array_split(some, 1 + int((n[y[some]] + n[x[some]]).sum()) // _AT_ONCE):
                a, b = y[part], x[part]
                common = _common(words, size, begin, n, a, b)
                found[a[100 * common >= percent * (n[a] + n[b] - common)]] = True
        rows = np.unique(head[2:5, found], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1].astype(np.int32)), pa.array(rows[2])], _LINE)


@tidied
def _line_sets(batches: Iterator[pa.RecordBatch], marked) -> Iterator[pa.RecordBatch]:
    chosen = (_with_marks(part, marked.value) for batch in batches for part in pieces(batch, "text"))
    for lines in _batches(chosen, None, marked.value):
        yield pa.RecordBatch.from_arrays([
            pa.array(lines.doc), pa.array(lines.line.astype(np.int32)), pa.array((lines.hash & np.uint64(0xFFFFFFFF)).view(np.int64)),
            pa.ListArray.from_arrays(pa.array(lines.bounds.astype(np.int32)), pa.array(lines.words.view(np.int64))),
        ], [*_LINE, "words"])


def _posted_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for packed in (part for found in whole_groups(batches, ["part"]) for part in _each_part(*found)):
        columns, _ = _unpacked(packed)
        rows = np.unique(np.stack([columns["doc"], columns["line"]]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1].astype(np.int32))], ["doc", "line"])


def _marked_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally = Tally(MARK_BITS)
    for batch in batches:
        tally.add(_mark(batch.column("doc").to_numpy(), batch.column("line").to_numpy(), MARK_BITS))
    yield from tally.batches()


def _marked_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally = Tally(MARK_BITS)
    for batch in batches:
        tally.add(places(batch.column("words").flatten().to_numpy().view(np.uint64), MARK_BITS))
    yield from tally.batches()


def repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, tuning: Tuning = Tuning()
) -> DataFrame:
    """``doc``, ``line`` (from 0) and ``hash`` (32 bits, of the line's words) of the lines to remove.

    A line goes if the corpus holds an earlier line, by key and then by number, whose set of
    words has a Jaccard similarity of ``percent`` / 100 or more with its own; whether that one
    goes too doesn't matter. Lines without words never go and remove nothing, and neither do
    lines of rows with a null key. Rows that repeat a key stand at the same place: equal lines of
    theirs both stay unless another document has the line before.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    rows = rows.where("doc is not null and text is not null")
    share = spark.sparkContext.broadcast
    survey = scratch_copy(rows.mapInArrow(_survey, f"{_LINE_TYPE}, again boolean, {Tally.FIELDS}"), "survey")
    table = share(build_table(survey.where("block is not null"), BITS))
    lines = survey.where("hash is not null").select(*_LINE, "again")

    def marks(rows: DataFrame, marked) -> np.ndarray:
        return build_table(rows.mapInArrow(marked, Tally.FIELDS), MARK_BITS)

    def confirmed(candidates: DataFrame, sets: DataFrame) -> DataFrame:
        left = sets.withColumnRenamed("words", "_s")
        right = sets.toDF("doc2", "line2", "hash2", "_t")
        both = candidates.join(left, _LINE).join(right, ["doc2", "line2", "hash2"])
        common = F.size(F.array_intersect("_s", "_t"))
        similar = 100 * common >= percent * (F.size("_s") + F.size("_t") - common)
        itself = F.struct(*_LINE) == F.struct("doc2", "line2", "hash2")
        return both.where(similar & ~itself).select(*_LINE).distinct()

    def sets_of(wanted: DataFrame) -> DataFrame:
        marked = share(marks(wanted, _marked_lines))
        sets = rows.mapInArrow(partial(_line_sets, marked=marked), f"{_LINE_TYPE}, words array<long>")
        return scratch_copy(sets, "lines")

    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def dealt(packed: DataFrame) -> DataFrame:
        """As many parts in each partition: by hash some would have three times as many, and a task holds them all."""
        dealt = packed.repartitionById(parts // 4, F.pmod("part", F.lit(parts // 4)).cast("int"))
        return dealt.sortWithinPartitions("part")

    def postings(again=None) -> DataFrame:
        packed = partial(_postings, table=table, percent=percent, parts=parts, tuning=tuning, again=again)
        return dealt(rows.mapInArrow(packed, "part long, postings binary"))

    def meet(sets: DataFrame, asking: DataFrame) -> DataFrame:
        """Asking lines with a similar line before them among the lines of ``sets``."""
        marked = sets.join(asking.withColumn("asks", F.lit(True)), _LINE, "left")
        marked = marked.withColumn("asks", F.coalesce("asks", F.lit(False)))
        asked = share(marks(marked.where("asks"), _marked_words))
        packed = partial(_meetings, table=table, percent=percent, parts=parts, tuning=tuning, asked=asked)
        packed = marked.mapInArrow(packed, _MEETING)
        return dealt(packed).mapInArrow(partial(_met, percent=percent), _LINE_TYPE)

    tried = postings().mapInArrow(partial(_candidates, percent=percent, tuning=tuning), _CANDIDATE)
    tried = scratch_copy(tried, "tried")
    lines_, pairs = tried.where("doc2 is null").select("doc", "line"), tried.where("doc2 is not null")
    wanted = lines_.unionByName(pairs.select("doc", "line"))
    sets = sets_of(wanted.unionByName(pairs.select(F.col("doc2").alias("doc"), F.col("line2").alias("line"))))
    closest = F.min_by(F.struct("doc2", "line2", "hash2"), F.struct("apart", "doc2", "line2")).alias("_x")
    asking = scratch_copy(pairs.groupBy(*_LINE).agg(
        closest, F.max("others").alias("others"), F.max("more").alias("more"), F.count_distinct("doc2", "line2").alias("_n")
    ).select(*_LINE, "_x.*", (F.col("others") | (F.col("_n") > 1)).alias("others"), "more"), "asking")
    found = scratch_copy(confirmed(asking.drop("others", "more"), sets), "found")
    left = asking.join(found, _LINE, "left_anti").where("others or more").select(*_LINE, "more")
    left = scratch_copy(left, "left")
    if not left.isEmpty():
        found = scratch_copy(found.unionByName(meet(sets, left.select(*_LINE)).distinct()), "found")
    # searches that ended at a candidate that wasn't similar after all, or words in chunks
    left = scratch_copy(left.where("more").join(found, _LINE, "left_anti").select(*_LINE), "left")
    if not left.isEmpty():
        again = marks(left, _marked_lines), marks(sets.join(left, _LINE, "left_semi"), _marked_words)
        members = postings(share(again)).mapInArrow(_posted_lines, "doc long, line int")
        found = found.unionByName(meet(sets_of(members.distinct()), left))

    # equal lines: those of later documents, and later ones of the same document
    low = F.col("hash").bitwiseAND(0xFFFFFFFF).alias("hash")
    repeats = lines.where("not again").groupBy("hash").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("_n"))
    repeats = scratch_copy(repeats.where("_n > 1").drop("_n"), "repeats")
    copies = lines.where("not again").join(repeats, "hash").where("doc <> first").select("doc", "line", low)
    copies = copies.unionByName(lines.where("again").select("doc", "line", low))
    return found.select(*_LINE).unionByName(copies).distinct()


def deduplicate_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, tuning: Tuning = Tuning()
) -> DataFrame:
    """``docs`` without the lines that :func:`repeated_lines` names.

    All columns stay, ``text`` is shortened, and ``n_lines`` and ``n_removed`` are added (columns
    of these names are replaced). A null text stays null and has no lines; an empty text has one
    line, without words. A document of which every line goes stays with an empty text.
    """
    gone = repeated_lines(docs, key, text, percent, tuning).groupBy("doc").agg(
        F.sort_array(F.collect_set(F.struct("line", "hash"))).alias("_gone")
    )
    again = docs.groupBy(F.col(key).cast("long").alias("doc")).agg(F.count(F.lit(1)).alias("_rows"))
    again = again.where("_rows > 1")
    gone = gone.withColumnRenamed("doc", "_doc")
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    own = {c: f"_column{i}" for i, c in enumerate(columns) if c != text}  # whatever their names; the text goes once
    joined = docs.select(*[F.col(f"`{c}`").alias(x) for c, x in own.items()], F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))
    joined = joined.join(gone.hint("shuffle_hash"), F.col("_key") == F.col("_doc"), "left")
    lines = F.col("_gone")
    if not again.isEmpty():  # rows that share a key may have other texts: compare the lines' words
        joined = joined.join(again.withColumnRenamed("doc", "_shared"), F.col("_key") == F.col("_shared"), "left")
        shared = F.col("_shared").isNotNull()
        hashed = F.arrow_udf(_own_lines, "array<struct<line:int,hash:bigint>>")(F.when(shared, F.col("_text")))
        lines = F.when(shared, F.array_intersect(hashed, lines)).otherwise(lines)
    joined = joined.withColumn("_lines", F.coalesce(lines["line"], F.array().cast("array<int>")))
    breaks = F.octet_length("_text") - F.octet_length(F.replace(F.col("_text"), F.lit("\n")))
    joined = joined.withColumns({
        "_breaks": F.coalesce(breaks + 1, F.lit(0)).cast("long"),
        "_text": F.when(F.size("_lines") > 0, _without(F.col("_text"), F.col("_lines"))).otherwise(F.col("_text")),
    })
    kept = [F.col(own.get(c, "_text")).alias(c) for c in columns]
    return joined.select(*kept, F.col("_breaks").alias("n_lines"), F.size("_lines").cast("long").alias("n_removed"))


def _without(text: Column, gone: Column) -> Column:
    """The text without the lines of these numbers, in time that grows with its length.

    The lines are bound to a variable, so that the text is split once and not for every line.
    """
    def rest(v: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(v["lines"]) - 1), v["gone"])
        return F.array_join(F.transform(kept, lambda i: F.get(v["lines"], i)), "\n")

    return F.transform(F.array(F.struct(F.split(text, "\n", -1).alias("lines"), gone.alias("gone"))), rest)[0]


def _own_lines(texts: pa.Array) -> pa.Array:
    out = []
    for value in texts.to_pylist():
        if value is None:
            out.append([])
            continue
        own = split_lines(pa.RecordBatch.from_pydict({"doc": [0], "text": [value]}))
        hashes = (own.hash & np.uint64(0xFFFFFFFF)).tolist()
        out.append([{"line": line, "hash": h} for line, h in zip(own.line.tolist(), hashes, strict=True)])
    return pa.array(out, pa.list_(pa.struct([("line", pa.int32()), ("hash", pa.int64())])))
