"""Removing passages that occur more than once, with sharded Aho-Corasick automata.

A passage is a run of windows of a fixed number of words. Equal windows pick the same anchor, the
phrase of a few words in them with the smallest hash, so only windows at anchors that occur twice
can recur. Such windows travel to the shard of their anchor with the words that they span. A shard
confirms the windows that occur twice, compiles them into an automaton over word numbers and
streams all spans of the shard, from all documents, through it to locate every occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_marts.llm.groups import clustered, whole_groups
from catalog_marts.llm.sketch import Tally, build_table, decoded, places
from catalog_marts.llm.text import SPACE, hash_words, mix, pieces, utf8
from catalog_marts.sources import scratch_copy

BITS = 25  # of the table of recurring anchors: 32 MB; a fuller table only lets more spans travel
HOT = 1000  # windows of an anchor with more batches than this meet by window, not by anchor
BLOCK = 1 << 19  # windows looked at together
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Spans(NamedTuple):
    """Runs of windows with the same anchor: of window starts ``first`` to ``last`` in ``words``."""

    anchor: np.ndarray
    first: np.ndarray
    last: np.ndarray
    words: np.ndarray  # hashes of all words of the batch
    windows: np.ndarray  # hash of the window that starts at a word, where that is inside its text
    row: np.ndarray  # the text of each span
    begin: np.ndarray  # where its words begin


def _rolled(values: np.ndarray, length: int) -> np.ndarray:
    """Hash of ``length`` consecutive values from each position; the last ones are not valid."""
    result, done, power, block = None, 0, 1, values
    factor = int(_STEP)
    while True:
        if length & power:
            if result is None:
                result = block
            else:
                moved = np.zeros_like(block)
                moved[: max(0, len(block) - done)] = block[done:]
                result = result * np.uint64(pow(factor, power, 2**64)) + moved
            done += power
        power *= 2
        if power > length:
            return mix(result)
        moved = np.zeros_like(block)
        moved[: max(0, len(block) - power // 2)] = block[power // 2 :]
        block = block * np.uint64(pow(factor, power // 2, 2**64)) + moved


def find_spans(column: pa.Array, window: int, phrase: int) -> Spans:
    data, offsets = utf8(column)
    found = hash_words(data, offsets)
    words, bounds = found.hashes, found.bounds
    row = np.repeat(np.arange(len(column)), np.diff(bounds))
    valid = np.arange(len(words)) + window <= bounds[row + 1] if len(words) else np.empty(0, bool)
    windows = _rolled(words, window) if len(words) else words
    phrases = _rolled(words, phrase) if len(words) else words
    width, anchors, firsts, lasts = window - phrase + 1, [], [], []
    for low in range(0, len(words), BLOCK):
        starts = np.flatnonzero(valid[low : low + BLOCK]) + low
        if not len(starts):
            continue
        part = phrases[low : low + BLOCK + width]
        # smallest phrase hash of each window, the leftmost one of equals
        least = (part & ~np.uint64(0xFFFFF)) | np.arange(len(part), dtype=np.uint64)
        span = 1
        while 2 * span <= width:
            least[: len(least) - span] = np.minimum(least[: len(least) - span], least[span:])
            span *= 2
        if span < width:
            rest = width - span
            least[: len(least) - rest] = np.minimum(least[: len(least) - rest], least[rest:])
        at = (least[starts - low] & np.uint64(0xFFFFF)).astype(np.int64) + low
        new = np.ones(len(starts), bool)
        new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
        begin = np.flatnonzero(new)
        anchors.append(phrases[at[begin]])
        firsts.append(starts[begin])
        lasts.append(starts[np.append(begin[1:], len(starts)) - 1])
    none = np.empty(0, np.int64)
    first = np.concatenate([*firsts, none])
    of = row[first] if len(first) else none
    return Spans(np.concatenate([*anchors, none.view(np.uint64)]), first, np.concatenate([*lasts, none]), words, windows, of, bounds[of] if len(of) else none)


def _anchors(batches: Iterator[pa.RecordBatch], window: int, phrase: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Anchors of a batch, once or twice, packed by the part that counts them."""
    for batch in batches:
        found = [find_spans(p.column("text"), window, phrase).anchor for p in pieces(batch, "text")]
        anchor, n = np.unique(np.concatenate([*found, np.empty(0, np.uint64)]), return_counts=True)
        part = (mix(anchor) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        anchor, n, part = anchor[order], np.minimum(n[order], 2).astype(np.uint8), part[order]
        low = np.flatnonzero(np.append(True, part[1:] != part[:-1])[: len(part)])
        high = np.append(low[1:], len(part))
        packed = [anchor[a:b].tobytes() + n[a:b].tobytes() for a, b in zip(low, high, strict=False)]
        yield pa.RecordBatch.from_arrays([pa.array(part[low]), pa.array(packed, pa.binary())], ["part", "anchors"])


def _recurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally = Tally(BITS)
    for table, bounds in whole_groups(batches, ["part"]):
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            anchors, counts = [], []
            for value in table["anchors"].combine_chunks()[low:high]:
                data = value.as_buffer()
                anchors.append(np.frombuffer(data, np.uint64, data.size // 9))
                counts.append(np.frombuffer(data, np.uint8, data.size // 9, data.size // 9 * 8))
            anchor, place = np.unique(np.concatenate(anchors), return_inverse=True)
            n = np.bincount(place, np.concatenate(counts))
            tally.add(places(anchor[n > 1], BITS), n[n > 1])
    yield from tally.batches()


class _Chosen(NamedTuple):
    key: np.ndarray
    content: np.ndarray  # hash of the span's words
    first: np.ndarray
    last: np.ndarray
    span: np.ndarray


def _choose(spans: Spans, table: np.ndarray, hot_from: int) -> _Chosen:
    """Spans at recurring anchors; those at hot anchors one window at a time."""
    count = table[places(spans.anchor, BITS)]
    some = np.flatnonzero(count > 0)
    hot = decoded(count[some]) > hot_from
    times = np.where(hot, spans.last[some] - spans.first[some] + 1, 1)
    span = np.repeat(some, times)
    step = np.arange(len(span)) - np.repeat(np.cumsum(times) - times, times)
    first = spans.first[span] + step
    last = np.where(np.repeat(hot, times), first, spans.last[span])
    key = np.where(np.repeat(hot, times), spans.windows[first], spans.anchor[span])
    content = mix(spans.windows[first] * _STEP + mix(spans.windows[last]) + (last - first).astype(np.uint64))
    return _Chosen(key, content, first, last, span)


def _spans(batches: Iterator[pa.RecordBatch], table, window: int, phrase: int, parts: int, hot: int) -> Iterator[pa.RecordBatch]:
    """Words of the chosen spans, equal ones of a piece of a batch once, packed by shard."""
    table = table.value
    for batch in batches:
        for piece in pieces(batch, "text"):
            spans = find_spans(piece.column("text"), window, phrase)
            chosen = _choose(spans, table, hot)
            content, at, times = np.unique(chosen.content, return_index=True, return_counts=True)
            part = (mix(chosen.key[at]) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            at, content, times, part = at[order], content[order], times[order], part[order]
            first, length = chosen.first[at], chosen.last[at] - chosen.first[at] + window
            ends = np.cumsum(length)
            place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - length, length) + np.repeat(first, length)
            numbers = (spans.words[place] >> np.uint64(32)).astype("<u4")
            low = np.flatnonzero(np.append(True, part[1:] != part[:-1])[: len(part)])
            high = np.append(low[1:], len(part))
            ends = np.append(0, ends)
            rows = [
                (part[a], b - a, content[a:b].tobytes() + times[a:b].astype("<u4").tobytes()
                 + length[a:b].astype("<u4").tobytes() + numbers[ends[a] : ends[b]].tobytes())
                for a, b in zip(low, high, strict=False)  # no spans: no part
            ]
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.binary()),
            ], ["part", "n", "spans"])


def _located(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """One automaton per shard: the recurring windows of its spans; and where they occur in them."""
    for table, bounds in whole_groups(batches, ["part"]):
        blobs, counts = table["spans"].combine_chunks(), table["n"].to_numpy()
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            columns: list[list[np.ndarray]] = [[], [], [], []]
            for row in range(low, high):
                data, n = blobs[row].as_buffer(), int(counts[row])
                columns[0].append(np.frombuffer(data, np.uint64, n))
                columns[1].append(np.frombuffer(data, "<u4", n, 8 * n))
                columns[2].append(np.frombuffer(data, "<u4", n, 12 * n))
                columns[3].append(np.frombuffer(data, "<u4", -1, 16 * n))
            content, times, length, numbers = (np.concatenate(c) for c in columns)
            yield _search(content, times.astype(np.int64), length.astype(np.int64), numbers, window)


def _search(content, times, length, numbers, window: int) -> pa.RecordBatch:
    begin = np.cumsum(length) - length
    # confirm: a window recurs if the spans that hold it stand for two places or more
    hashes = _rolled(mix(numbers.astype(np.uint64)), window)
    span = np.repeat(np.arange(len(length)), length)
    starts = np.flatnonzero(np.arange(len(numbers)) - begin[span] + window <= length[span])
    value, place, inverse = np.unique(hashes[starts], return_index=True, return_inverse=True)
    recurs = np.bincount(inverse, times[span[starts]])[inverse] > 1
    # first and last window of each run of recurring ones cover the words of the run
    run = recurs.copy()
    run[1:] &= ~(recurs[:-1] & (starts[1:] == starts[:-1] + 1) & (span[starts][1:] == span[starts][:-1]))
    stop = recurs.copy()
    stop[:-1] &= ~(recurs[1:] & (starts[1:] == starts[:-1] + 1) & (span[starts][1:] == span[starts][:-1]))
    edges = np.unique(inverse[run | stop])
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for at in starts[place[edges]].tolist():
        automaton.add_word(tuple(numbers[at : at + window].tolist()), 1)
    out: list[tuple[int, int, int]] = []
    if len(edges):
        automaton.make_automaton()
        kept, first = np.unique(content, return_index=True)  # equal spans of several batches: once
        held = np.zeros(len(length), bool)
        held[np.unique(span[starts[recurs]])] = True
        known = content.view(np.int64).tolist()
        for k in first[held[first]].tolist():
            words = numbers[begin[k] : begin[k] + length[k]].tolist()
            low = high = -1
            for end, _ in automaton.iter(tuple(words)):
                start = end - window + 1
                if start > high:
                    if high > 0:
                        out.append((known[k], low, high))
                    low = start
                high = end + 1
            if high > 0:
                out.append((known[k], low, high))
    rows = np.array(out, np.int64).reshape(-1, 3)
    return pa.RecordBatch.from_arrays([pa.array(rows[:, k]) for k in range(3)], ["content", "low", "high"])


def _places(batches: Iterator[pa.RecordBatch], table, window: int, phrase: int, hot: int) -> Iterator[pa.RecordBatch]:
    """Where the chosen spans stand: row, first word, content."""
    table = table.value
    for batch in batches:
        for piece in pieces(batch, "text"):
            spans = find_spans(piece.column("text"), window, phrase)
            chosen = _choose(spans, table, hot)
            rows = pa.array(spans.row[chosen.span])
            first = chosen.first - spans.begin[chosen.span]
            yield pa.RecordBatch.from_arrays([
                piece.column("doc").take(rows), piece.column("hash").take(rows), pa.array(first), pa.array(chosen.content.view(np.int64)),
            ], ["doc", "hash", "first", "content"])


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 35, phrase: int = 12, hot: int = HOT
) -> DataFrame:
    """Words of each text that no recurring window covers.

    A window is ``window`` consecutive words of one text; it recurs if its words stand anywhere
    else in the table too, in the same text or another. Words are taken unchanged; a word covered
    by a recurring window goes, with all its occurrences judged on the input.

    Returns ``key``, ``n_words``, ``n_removed`` and ``kept``, the words left, joined by one space.
    Null, empty and short texts have no windows; a null text has no words and an empty ``kept``.
    Repeated rows count one by one, so a text of ``window`` words or more that occurs twice goes
    as a whole; null keys are kept and treated like others. Extra columns are ignored; an empty
    table gives an empty table.
    """
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    kind = docs.schema[key].dataType.simpleString()
    sized = partial(partial, window=window, phrase=phrase)

    anchors = rows.select("text").mapInArrow(sized(_anchors, parts=parts), "part long, anchors binary")
    recurring = clustered(anchors, ["part"]).mapInArrow(_recurring, Tally.FIELDS)
    table = spark.sparkContext.broadcast(build_table(recurring, BITS))

    spans = rows.select("text").mapInArrow(sized(_spans, table=table, parts=parts, hot=hot), "part long, n long, spans binary")
    located = clustered(spans, ["part"]).mapInArrow(partial(_located, window=window), "content long, low long, high long")
    located = scratch_copy(located, "located")
    places_ = rows.mapInArrow(sized(_places, table=table, hot=hot), f"doc {kind}, hash long, first long, content long")
    covered = places_.join(located, "content").select(
        "doc", "hash", F.struct((F.col("first") + F.col("low")).alias("low"), (F.col("first") + F.col("high")).alias("high")).alias("_c")
    )
    covered = covered.groupBy(F.col("doc").alias("_doc"), F.col("hash").alias("_hash")).agg(F.collect_set("_c").alias("_gone"))
    joined = rows.join(covered, rows["doc"].eqNullSafe(F.col("_doc")) & (F.col("hash") == F.col("_hash")), "left")

    def keep(texts: pa.Array, gone: pa.Array) -> pa.Array:
        sizes, removed, kept = [], [], []
        ends = gone.offsets.to_numpy()
        low, high = (gone.values.field(k).to_numpy() for k in (0, 1))
        data, offsets = utf8(texts)
        words = hash_words(data, offsets)
        for row in range(len(texts)):
            n = int(words.bounds[row + 1] - words.bounds[row])
            body = data[offsets[row] : offsets[row + 1]].tobytes()
            parts = body.translate(_TO_SPACE).split()
            cover = np.zeros(n + 1, np.int64)
            np.add.at(cover, low[ends[row] : ends[row + 1]], 1)
            np.add.at(cover, high[ends[row] : ends[row + 1]], -1)
            left = np.flatnonzero(np.cumsum(cover[:n]) == 0)
            sizes.append(n)
            removed.append(n - len(left))
            kept.append(b" ".join(parts if len(left) == n else [parts[i] for i in left.tolist()]).decode())
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["n_words", "n_removed", "kept"])

    keep = F.arrow_udf(keep, "n_words long, n_removed long, kept string")
    gone = F.coalesce("_gone", F.array().cast("array<struct<low:bigint,high:bigint>>"))
    joined = joined.withColumn("_k", keep(F.col("text"), gone))
    return joined.select(F.col("doc").alias(key), "_k.n_words", "_k.n_removed", "_k.kept")


_TO_SPACE = bytes(32 if SPACE[b] else b for b in range(256))
