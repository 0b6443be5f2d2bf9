"""Packing token sequences of documents into training sequences of fixed capacity.

Which documents share a sequence depends on their lengths alone, and there are at most
``capacity`` different ones. So the packing is planned on the histogram of lengths: bins are
filled one after the other by the minimum bin slack rule, each with the fullest combination of the
lengths that are left, found by a subset-sum over bit sets. A combination is used as often as the
histogram allows before the next one is looked for. Documents then take their places by their
number within their length, in parallel.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from catalog_marts.llm.held import held
from catalog_marts.llm.segments import cut_at_spaces, gathered, large_strings
from catalog_marts.llm.text import pieces, utf8
from catalog_marts.sources import scratch_copy

CAPACITY = 4096  # tokens of a sequence
END = 1  # id behind every document
KEEP_WORDS, KEEP_CHARS = 600_000, 64  # bounds of a worker's cache of encoded words
BLOCK = 8 << 20  # bytes of text encoded at a time; one text at least

#: Words that the normalizer leaves as they are, and how byte-level vocabularies write the bytes
#: of those that are no printable character.
_LETTERS = re.compile("[a-zß-öø-ÿ]+").fullmatch
_BYTES = {0x7F + k: 289 + k for k in range(34)} | {0xAD: 323}


class Plan(NamedTuple):
    """Where the documents of a length go; rows sorted by ``length`` and ``first``.

    Number ``first`` of a length and those after it go into the sequences from ``sequence`` on,
    ``uses`` into each, the first of them at ``offset``.
    """

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    uses: np.ndarray
    offset: np.ndarray
    sequences: int

    def places(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of every document, given its length and number within the length."""
        shift = np.int64(48)  # of a length fewer than 2 ** 48 documents
        at = np.searchsorted((self.length << shift) + self.first, (length << shift) + number, "right") - 1
        local = number - self.first[at]
        return self.sequence[at] + local // self.uses[at], self.offset[at] + local % self.uses[at] * length


def _fullest(left: Mapping[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """The combination of lengths whose sum comes closest to ``room``, as uses by length.

    Bit ``s`` of ``reach`` says whether some combination has sum ``s``. Several documents of one
    length are added in doubling steps, so a length takes a logarithmic number of shifts.
    """
    reach, mask, steps = 1, (1 << room + 1) - 1, []
    for length in lengths:
        count, step = min(left[length], room // length), 1
        while count > 0 and not reach >> room:
            step = min(step, count)
            more = (reach | reach << step * length) & mask
            if more != reach:
                steps.append((length, step, reach))
                reach = more
            count, step = count - step, 2 * step
        if reach >> room:
            break
    total, uses = reach.bit_length() - 1, {}
    for length, step, before in reversed(steps):
        if not before >> total & 1:
            uses[length] = uses.get(length, 0) + step
            total -= step * length
    return uses


def minimum_bin_slack(histogram: Mapping[int, int], capacity: int = CAPACITY) -> Plan:
    """Fill sequences one after the other, each with the largest length left and the fullest
    combination of the others.

    The work depends on ``capacity``, not on the number of documents: every combination is
    repeated until one of its lengths is short, and a length gets short a bounded number of times
    (at most ``capacity / length``).
    """
    left = {int(k): int(n) for k, n in histogram.items() if n}
    if any(not 0 < k <= capacity for k in left):
        raise ValueError("lengths must be from 1 to the capacity")
    taken, rows, sequence = dict.fromkeys(left, 0), [], 0
    lengths = sorted(left, reverse=True)
    while lengths:
        largest = lengths[0]
        left[largest] -= 1
        uses = _fullest(left, lengths, capacity - largest)
        left[largest] += 1
        uses[largest] = uses.get(largest, 0) + 1
        repeat, offset = min(left[k] // n for k, n in uses.items()), 0
        for length in sorted(uses, reverse=True):
            rows.append((length, taken[length], sequence, uses[length], offset))
            offset += length * uses[length]
            taken[length] += repeat * uses[length]
            left[length] -= repeat * uses[length]
        sequence += repeat
        lengths = [k for k in lengths if left[k]]
    columns = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return Plan(*columns, sequence)


class _Words:
    """Ids of words as bytes; keeps short words that it has met, up to a bound.

    The vocabulary's tokenizer drops white space and never joins what stands on either side of it,
    so words can be encoded one by one. What follows saves calls, and gives the same ids: letters
    are lower-cased anyway, and a full stop or comma behind a letter is a piece of its own.
    """

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer, self.known, self.earlier = tokenizer, {}, {}

    def _plain(self, words: Iterable[str]) -> dict[str, bytes]:
        """Encoded without the memory. A word of small Latin letters is one piece, as it stands."""
        ids, others, tokenize = {}, [], self.tokenizer.model.tokenize
        for word in words:
            if not _LETTERS(word):
                others.append(word)
                continue
            as_bytes = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTES)
            ids[word] = array("I", [t.id for t in tokenize(as_bytes)]).tobytes()
        coded = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
        ids.update((word, array("I", x.ids).tobytes()) for word, x in zip(others, coded, strict=True))
        return ids

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words not met before; those with a mark behind a letter get them from the rest."""
        marked = {w for w in words if w[-1:] in (".", ",") and w[-2:-1].isalpha() and "<" not in w}
        stems = {w[:-1] for w in marked} | {".", ","}
        found = {w: self.known[w] for w in stems if w in self.known}
        found.update(self._plain((words - marked) | (stems - found.keys())))
        found.update((w, found[w[:-1]] + found[w[-1]]) for w in marked)
        return found

    def _ids(self, words: list[str]) -> list[bytes]:
        if len(self.known) > KEEP_WORDS:  # those in use come back from the earlier ones
            self.known, self.earlier = {}, self.known
        missing = set(words).difference(self.known)
        met = {word: self.earlier[word] for word in missing if word in self.earlier}
        self.known.update(met)
        learnt = self._learn(missing.difference(met))
        self.known.update((word, ids) for word, ids in learnt.items() if len(word) <= KEEP_CHARS)
        return [ids if (ids := self.known.get(word)) is not None else learnt[word] for word in words]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where those of each begin and end."""
        cut = cut_at_spaces(*_lowered(*utf8(texts)))
        coded = self._ids(cut.distinct.to_pylist())
        lengths = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        starts, ids = np.cumsum(lengths) - lengths, np.frombuffer(b"".join(coded), "<u4")
        bounds = np.append(0, np.cumsum(lengths[cut.index]))[cut.bounds]
        return ids[gathered(starts[cut.index], lengths[cut.index])], bounds


def _lowered(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Other white space as spaces, ASCII letters in lower case, unless that could change what a
    letter composes to with the mark behind it, or make up a special token.
    """
    low = data.copy()
    low[(low == 9) | (low == 10) | (low == 13)] = 32
    texts = large_strings(low, offsets)
    as_is = pc.or_(pc.match_substring(texts, "<|"), pc.match_substring_regex(texts, "[\u0300-\u036f]"))
    kept = np.flatnonzero(as_is.to_numpy(zero_copy_only=False)).tolist()
    bytes_kept = [low[offsets[row] : offsets[row + 1]].copy() for row in kept]  # a few
    low += ((low - np.uint8(65)) < 26).view(np.uint8) << np.uint8(5)
    for row, own in zip(kept, bytes_kept, strict=True):
        low[offsets[row] : offsets[row + 1]] = own
    return low, offsets


def _encoder(vocabulary: str) -> _Words:
    return held(("packing", hash(vocabulary)), lambda: _Words(Tokenizer.from_str(vocabulary)))


def _cut(docs: DataFrame, vocabulary: str, capacity: int, end: int, key: str, text: str, keep_ids: bool) -> DataFrame:
    """Pieces of at most ``capacity`` ids, numbered within their length in the reading task."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "number", "task"]
    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids binary, number long, task int"
    types = [None, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, task = _encoder(shared.value), TaskContext.get().partitionId()
        seen, closing = [0] * (capacity + 1), np.array([end], "<u4").tobytes()
        for batch in batches:
            for part in pieces(batch, text, BLOCK):
                found, row_of = [[] for _ in types[1:]], []
                every, bounds = words.encode(part.column(text))
                for row in range(part.num_rows):
                    coded = every[bounds[row] : bounds[row + 1]].tobytes() + closing
                    for number, low in enumerate(range(0, len(coded), 4 * capacity)):
                        ids = coded[low : low + 4 * capacity]
                        length = len(ids) // 4
                        values = (number, low // 4, length, zlib.crc32(ids), ids if keep_ids else None, seen[length], task)
                        for column, x in zip(found, values, strict=True):
                            column.append(x)
                        row_of.append(row)
                        seen[length] += 1
                columns = [pa.array(v, t) for v, t in zip(found, types[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(key).take(pa.array(row_of, pa.int64())), *columns], names)

    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(run, schema)


def pack_sequences(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    end: int = END,
    key: str = "doc_id",
    text: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """Every document's ids, in sequences of at most ``capacity``.

    ``vocabulary`` is the path of a tokenizer file that the driver can read and whose tokenizer
    drops white space; special tokens are not added, ``end`` closes every document. A document
    beyond ``capacity`` ids is cut into pieces of ``capacity``, the last one may be shorter;
    others are never cut. Returns one row per piece: ``doc_id`` (the key), ``piece`` (from 0),
    ``start`` (ids of the document before it), ``length``, ``ids_crc32`` (of the ids as
    little-endian unsigned 32-bit integers), ``ids`` (these bytes; null unless ``keep_ids``),
    ``sequence_id`` (from 0) and ``offset`` in the sequence, without gaps.

    A null or empty text is the single id ``end``. Rows are documents of their own: null keys are
    kept, repeated keys and equal rows each get a place; an empty table gives an empty table;
    columns other than the two named are ignored. A text is encoded whole, however long.

    Calling this encodes all texts once and stores the pieces. The driver receives the histogram
    of lengths, at most ``capacity`` rows, and sends back a plan whose size depends on
    ``capacity`` alone. A length may belong to most documents: they are numbered inside the tasks
    that encode them, and only one count per task and length meets in a window.
    """
    with open(vocabulary, encoding="utf-8") as f:
        cut = _cut(docs, f.read(), capacity, end, key, text, keep_ids)
    rows = scratch_copy(cut, "pieces")
    counts = rows.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    histogram = rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``capacity`` rows
    plan = docs.sparkSession.sparkContext.broadcast(minimum_bin_slack({r["length"]: r["n"] for r in histogram}, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(k).to_numpy() for k in ("length", "number"))
            sequence, offset = plan.value.places(length, number)
            columns = [batch.column(k) for k in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    kept = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    numbered = rows.join(starts, ["length", "task"]).withColumn("number", F.col("number") + F.col("before"))
    types = ", ".join(f"{k} {t}" for k, t in rows.dtypes if k in kept)
    return numbered.select(*kept, "number").mapInArrow(place, f"{types}, sequence_id long, offset long")
