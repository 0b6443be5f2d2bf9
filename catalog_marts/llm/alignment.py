"""Alignment of the tokens of two tokenizers, and how many documents link each pair of ids.

Both tokenizers cut a text into tokens whose bytes join to the same string. Offsets at which tokens
of both end cut it into groups, and tokens that overlap are linked. Most ids of one vocabulary have
an id with the same bytes in the other one, or none: these pairs are counted in a vector as long as
the vocabulary, and only the pairs of groups in which the tokenizers differ are shuffled.

Neither tokenizer joins anything across the border between a letter, digit or ASCII mark and the
space behind it, so a text is aligned in parts that begin at such spaces, and equal parts of a
block of texts are aligned once.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import string
from collections.abc import Callable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from catalog_marts.llm.groups import clustered, whole_groups
from catalog_marts.llm.segments import Segments, cut_at_spaces, gathered
from catalog_marts.llm.text import mix, pieces, utf8
from catalog_marts.sources import scratch_copy

BLOCK = 4 << 20  # bytes of text aligned at a time; one text at least
ENCODED = 8192  # parts encoded at a time
PART_PAIRS = 1_000_000  # counts of id pairs that a task adds up at a time, about
SPACE = "▁"  # how piece vocabularies write a space


def byte_level_bytes(token: str) -> bytes:
    """Bytes of a token of a byte-level vocabulary: printable bytes stand for themselves, the others
    for the characters from 256 on.
    """
    return bytes(_BYTE_OF[c] for c in token) if all(c in _BYTE_OF for c in token) else token.encode()


_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHERS = [b for b in range(256) if b not in set(_PRINTABLE)]
_BYTE_OF = {chr(b): b for b in _PRINTABLE} | {chr(256 + k): b for k, b in enumerate(_OTHERS)}


def piece_bytes(piece: str) -> bytes:
    """Bytes of a piece: ``<0xHH>`` is a byte, U+2581 a space."""
    if re.fullmatch("<0x[0-9A-Fa-f]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(SPACE, " ").encode()


class Bytes(NamedTuple):
    """Byte strings one after the other; number ``i`` begins at ``starts[i]``."""

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, values: list[bytes]) -> Bytes:
        lengths = np.fromiter(map(len, values), np.int64, len(values))
        return cls(np.frombuffer(b"".join(values), np.uint8), np.cumsum(lengths) - lengths, lengths)

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        return self.data[gathered(self.starts[numbers], self.lengths[numbers])]


class Pair:
    """Two vocabularies: their encoders, the bytes of their ids, and the identity map.

    ``same[a]`` is the id of the second vocabulary with the bytes of ``a``, or -1. Where two ids
    have the same bytes, it is the one that is not a mere byte.
    """

    def __init__(self, first: str, second: bytes):
        self.first = Tokenizer.from_str(first)
        self.first.encode_special_tokens = True  # their strings are ordinary text
        self.second = sentencepiece.SentencePieceProcessor(model_proto=second)
        spec = json.loads(first)
        a = {i: byte_level_bytes(t) for t, i in spec["model"]["vocab"].items()}
        a |= {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
        ours = [a.get(i, b"") for i in range(max(a) + 1)]
        texts = [self.second.id_to_piece(i) for i in range(len(self.second))]
        theirs = [piece_bytes(t) for t in texts]
        number = {t: i for i, t in enumerate(theirs)}
        number |= {t: i for i, t in enumerate(theirs) if len(texts[i]) != 6}
        self.a, self.b = Bytes.of(ours), Bytes.of(theirs)
        self.same = np.array([number.get(t, -1) if t else -1 for t in ours], np.int64)
        na, nb = len(ours), len(theirs)
        marks = [f"{i}{m}" for m, n in ((",", na), ("|", na), (",", nb), (";", nb)) for i in range(n)]
        self.written = Bytes.of([x.encode() for x in marks])  # ids as they stand in a group's text


_loaded: dict[int, Pair] = {}  # the last vocabularies used in this worker process


def _pair(first: str, second: bytes) -> Pair:
    key = hash((first, second))
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Pair(first, second)
    return _loaded[key]


def _unjoined(parts: Segments) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Parts of texts that can be encoded one by one: strings, index and bounds as in ``parts``.

    A part that ends in anything but a letter, digit or ASCII mark takes the next one along, and
    an empty last part belongs to the one before it.
    """
    texts, index, bounds = parts.distinct.to_pylist(), parts.index, parts.bounds
    closed = np.fromiter((t[-1:].isalnum() or t[-1:] in _ASCII_MARKS for t in texts), bool, len(texts))
    joins = ~closed[index]
    last = bounds[1:] - 1
    joins[last] = False
    empty = np.fromiter((not t for t in texts), bool, len(texts))[index[last]] & (np.diff(bounds) > 1)
    joins[last[empty] - 1] = True
    if not joins.any():
        return texts, index, bounds
    number, found, sizes = {t: k for k, t in enumerate(texts)}, [], np.diff(bounds)
    odd = np.unique(np.searchsorted(bounds, np.flatnonzero(joins), "right") - 1)
    done = 0
    for row in odd.tolist():
        low, high = int(bounds[row]), int(bounds[row + 1])
        found.append(index[bounds[done] : low])
        own, held = [], None
        for k, more in zip(index[low:high].tolist(), joins[low:high].tolist(), strict=True):
            held = texts[k] if held is None else f"{held} {texts[k]}"
            if not more:
                own.append(number.setdefault(held, len(number)))
                held = None
        found.append(np.array(own, index.dtype))
        sizes[row], done = len(own), row + 1
    found.append(index[bounds[done] :])
    return list(number), np.concatenate(found), np.append(0, np.cumsum(sizes))


_ASCII_MARKS = frozenset(string.punctuation)


class Aligned(NamedTuple):
    """Parts aligned: of each, tokens, groups and links; the links of all parts in order.

    ``text`` and ``ends`` hold the groups of all parts as text, ``whole`` tells which parts both
    tokenizers give back byte by byte; the others have no tokens.
    """

    whole: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    a: np.ndarray
    b: np.ndarray
    text: bytes
    ends: np.ndarray


def _chosen(ids: np.ndarray, counts: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ids[np.repeat(keep, counts)], np.where(keep, counts, 0)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of ``counts[i]`` values each, in turn."""
    return np.diff(np.append(0, np.cumsum(values))[np.append(0, np.cumsum(counts))])


def _encoded(parts: list[str], encode: Callable[[list[str]], list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all parts, and how many each has; the encoder's own objects live for a few parts only."""
    ids, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for low in range(0, len(parts), ENCODED):
        lists = encode(parts[low : low + ENCODED])
        counts.append(np.fromiter(map(len, lists), np.int64, len(lists)))
        ids.append(np.fromiter(chain.from_iterable(lists), np.int64, int(counts[-1].sum())))
    return np.concatenate(ids), np.concatenate(counts)


def align(pair: Pair, parts: list[str]) -> Aligned:
    """Align parts; each of them stands for itself with a space before it."""
    texts = Bytes.of([b" " + t.encode() for t in parts])
    a, n_a = _encoded(parts, lambda some: [x.ids for x in pair.first.encode_batch_fast([" " + t for t in some], add_special_tokens=False)])
    b, n_b = _encoded(parts, lambda some: pair.second.encode(some, num_threads=1))

    whole = (_sums(pair.a.lengths[a], n_a) == texts.lengths) & (_sums(pair.b.lengths[b], n_b) == texts.lengths)
    a, n_a = _chosen(a, n_a, whole)
    b, n_b = _chosen(b, n_b, whole)
    numbers = np.flatnonzero(whole)
    wanted = texts.joined(numbers)
    wrong = (pair.a.joined(a) != wanted) | (pair.b.joined(b) != wanted)
    if wrong.any():
        owner = np.repeat(numbers, texts.lengths[numbers])
        keep = np.ones(len(parts), bool)
        keep[owner[wrong]] = False
        a, n_a = _chosen(a, n_a, keep)
        b, n_b = _chosen(b, n_b, keep)
        whole &= keep

    ends_a, ends_b = np.cumsum(pair.a.lengths[a]), np.cumsum(pair.b.lengths[b])
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    ends = np.union1d(ends_a, ends_b)  # between two of these lies one token of either side: a link
    part_ends = np.cumsum(np.where(whole, texts.lengths, 0))
    n_groups = np.diff(np.append(0, np.searchsorted(cuts, part_ends, "right")))
    n_links = np.diff(np.append(0, np.searchsorted(ends, part_ends, "right")))

    of_a, of_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
    in_a, in_b = np.bincount(of_a, minlength=len(cuts)), np.bincount(of_b, minlength=len(cuts))
    place_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[of_a] if len(cuts) else a
    place_b = np.arange(len(b)) + np.cumsum(in_a)[of_b] if len(cuts) else b
    last_a, last_b = np.append(of_a[1:] != of_a[:-1], True), np.append(of_b[1:] != of_b[:-1], True)
    token = np.empty(len(a) + len(b), np.int64)
    size_a, size_b = len(pair.a.lengths), len(pair.b.lengths)
    token[place_a] = a + np.where(last_a[: len(a)], size_a, 0)
    token[place_b] = b + 2 * size_a + np.where(last_b[: len(b)], size_b, 0)
    text_ends = np.cumsum(_sums(pair.written.lengths[token], n_a + n_b))
    return Aligned(
        whole, n_a, n_b, n_groups, n_links, a[np.searchsorted(ends_a, ends)], b[np.searchsorted(ends_b, ends)],
        pair.written.joined(token).tobytes(), text_ends,
    )


def _packed(values: np.ndarray) -> bytes:
    """Numbers from 0 on in as few bytes as the largest needs, compressed."""
    size = next(k for k in (1, 2, 4, 8) if not len(values) or int(values.max()) >> 8 * k == 0)
    return bytes([size]) + zstandard.ZstdCompressor(level=1).compress(values.astype(f"<u{size}").tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), f"<u{data[0]}").astype(np.int64)


def _steps(values: np.ndarray) -> bytes:
    return _packed(np.diff(values, prepend=0))


def _from_steps(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data))


#: What a block of texts is stored as. ``codes`` are its id pairs without those of the identity map,
#: as ``a * size + b`` in order, ``docs`` how many of its texts link them. A link's value is the
#: place of its pair in ``codes``, or behind these the first id of a pair of the identity map.
_STATE = ("n_a", "n_b", "n_groups", "n_links", "codes", "docs", "part_links", "values", "text_parts", "parts")


class _Counter:
    """Documents of one task by id pairs of the identity map: the vector of the fast path.

    A task has one core: threads of the encoder's own would wait for each other and for those of
    the other tasks, so they are off in its process.
    """

    def __init__(self, pair: Pair):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.pair, self.vector = pair, np.zeros(len(pair.same), np.int64)

    def block(self, column: pa.Array, keep_groups: bool) -> dict:
        pair, size = self.pair, len(self.pair.b.lengths)
        data, offsets = utf8(column)
        strings, index, bounds = _unjoined(cut_at_spaces(data, offsets))
        used, index = np.unique(index, return_inverse=True)
        aligned = align(pair, [strings[k] for k in used.tolist()])

        full = offsets[1:] > offsets[:-1]  # a text is whole if all its parts are
        full &= np.diff(np.append(0, np.cumsum(~aligned.whole[index]))[bounds]) == 0
        index, sizes = _chosen(index, np.diff(bounds), full)
        bounds = np.append(0, np.cumsum(sizes))

        plain = pair.same[aligned.a] == aligned.b
        codes, at = np.unique((aligned.a * size + aligned.b)[~plain], return_inverse=True)
        values = np.empty(len(plain), np.int64)
        values[~plain], values[plain] = at, len(codes) + aligned.a[plain]
        starts = np.cumsum(aligned.n_links) - aligned.n_links
        docs, place = np.zeros(len(codes) + len(pair.same), np.int64), np.empty(len(codes) + len(pair.same), np.int64)
        ends, digests, texts = np.append(0, aligned.ends).tolist(), [], []
        written = [aligned.text[low:high] for low, high in zip(ends[:-1], ends[1:], strict=True)]
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            own = index[low:high]
            linked = values[gathered(starts[own], aligned.n_links[own])]
            order = np.arange(len(linked))
            place[linked] = order  # the last place of a value stands for it
            docs[linked[place[linked] == order]] += 1
            text = b"".join([written[k] for k in own.tolist()])[:-1]
            digests.append(hashlib.sha256(text).hexdigest() if text else "")
            if keep_groups:
                texts.append(text.decode())
        self.vector += docs[len(codes) :]

        counts = {k: _sums(getattr(aligned, k)[index], sizes) for k in ("n_a", "n_b", "n_groups", "n_links")}
        state = {k: _packed(v) for k, v in counts.items()}
        state |= {"codes": _steps(codes), "docs": _packed(docs[: len(codes)])}
        state |= {"part_links": _packed(aligned.n_links), "values": _packed(values)}
        state |= {"text_parts": _packed(sizes), "parts": _packed(index)}
        return {**state, "digests": digests, "texts": texts, "pairs": len(codes)}


def _blocks(docs: DataFrame, shared, key: str, text: str, keep_groups: bool) -> DataFrame:
    """One row per block of texts, and one per task with its vector."""
    kind = docs.schema[key].dataType.simpleString()
    texts = ", texts array<string>" if keep_groups else ""
    schema = f"block long, keys array<{kind}>, digests array<string>{texts}, pairs long, vector binary, "
    schema += ", ".join(f"{k} binary" for k in _STATE)
    names = [x.split(" ")[0] for x in schema.split(", ")]

    def row(values: dict, keys: pa.Array) -> pa.RecordBatch:
        columns = {"keys": pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)}
        for k in ("digests", "texts"):
            columns[k] = pa.array([values.get(k, [])], pa.list_(pa.string()))
        for k in ("block", "pairs"):
            columns[k] = pa.array([values.get(k)], pa.int64())
        for k in ("vector", *_STATE):
            columns[k] = pa.array([values.get(k)], pa.binary())
        return pa.RecordBatch.from_arrays([columns[k] for k in names], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(_pair(*shared.value))
        number, keys = TaskContext.get().partitionId() << 32, None
        for batch in batches:
            for part in pieces(batch, text, BLOCK):
                keys = part.column(key)
                yield row({**counter.block(part.column(text), keep_groups), "block": number}, keys)
                number += 1
        if keys is not None:
            yield row({"vector": _packed(counter.vector)}, keys.slice(0, 0))

    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(run, schema)


def _dealt(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """A block's pairs by part of all pairs."""
    for batch in batches:
        for block, codes, docs in zip(*(batch.column(k).to_pylist() for k in ("block", "codes", "docs")), strict=True):
            codes, docs = _from_steps(codes), _unpacked(docs)
            if not len(codes):
                continue
            part = (mix(codes.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            own, first = np.unique(part[order], return_index=True)
            rows = [(c, d) for c, d in zip(np.split(codes[order], first[1:]), np.split(docs[order], first[1:]), strict=True)]
            columns = [pa.array(own), pa.array([block] * len(own)), pa.array([_steps(c) for c, _ in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([_packed(d) for _, d in rows], pa.binary())], ["part", "block", "codes", "docs"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a part: one row with all of them (no block), and one for each block that asked, without
    the pairs that no other block has.
    """
    for table, bounds in whole_groups(batches, ["part"]):
        blocks = table["block"].to_pylist()
        codes = [_from_steps(x) for x in table["codes"].to_pylist()]
        docs = [_unpacked(x) for x in table["docs"].to_pylist()]
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            every, at = np.unique(np.concatenate(codes[low:high]), return_inverse=True)
            total = np.bincount(at, np.concatenate(docs[low:high])).astype(np.int64)
            rows, done = [(None, _steps(every), _packed(total))], 0
            for k in range(low, high):
                found = total[at[done : done + len(codes[k])]]
                done += len(codes[k])
                more = found > docs[k]
                if more.any():
                    rows.append((blocks[k], _steps(codes[k][more]), _packed(found[more])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)],
                ["block", "codes", "docs"],
            )


def align_tokenizers(
    docs: DataFrame, first: str, second: str, key: str = "doc_id", text: str = "text", keep_groups: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Groups and links of two tokenizers in every text, and the documents that link each pair.

    ``first`` is the path of a byte-level tokenizer file, which encodes space and text, ``second``
    that of a piece model that adds the space itself; the driver reads both. Returns two frames.

    Per row of ``docs``: ``doc_id`` (the key), ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``
    (pairs of tokens that overlap), ``count_sum`` (over links, the number of rows of ``docs`` that
    link their pair of ids), ``n_best`` (links whose count is the highest of their first id, ties
    included), ``groups_sha256`` and ``groups``: the ids as ``a1,a2|b1;a3|b2,b3`` (null without
    ``keep_groups``, which saves the space they take on the way; the digest is '' without tokens).
    Per pair of ids that some row links: ``a``, ``b``, ``docs``.

    A text that is null or empty, or that one of the tokenizers does not give back byte by byte,
    has no tokens: all its numbers are 0. Rows count one by one, those that repeat a key or a whole
    row too; null keys stay; other columns are ignored; an empty table gives empty frames. Texts
    are aligned whole, whatever their length.

    Every text is encoded once. A block of texts keeps the parts of its texts and the links of its
    parts in a scratch table, and sends each of its id pairs once, with a count, to the task that
    adds it up; so no key has more rows than there are blocks. The counts come back to the block.
    The driver sees two numbers per id of the first vocabulary. Runs its jobs when called.
    """
    with open(first, encoding="utf-8") as f, open(second, "rb") as g:
        files = (f.read(), g.read())
    spark, pair = docs.sparkSession, _pair(*files)
    shared = spark.sparkContext.broadcast(files)
    size, ids = len(pair.b.lengths), len(pair.same)
    blocks = scratch_copy(_blocks(docs, shared, key, text, keep_groups), "aligned")

    vectors = blocks.where("vector is not null").select("vector").mapInArrow(_as_rows, "a long, n long")
    plain = {r["a"]: r["n"] for r in vectors.groupBy("a").agg(F.sum("n").alias("n")).collect()}
    states = blocks.where("block is not null").drop("vector")
    entries = states.agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-entries // PART_PAIRS))
    dealt = states.select("block", "codes", "docs").mapInArrow(
        lambda batches: _dealt(batches, parts), "part long, block long, codes binary, docs binary"
    )
    added = scratch_copy(clustered(dealt, ["part"], ["block"]).mapInArrow(_added, "block long, codes binary, docs binary"), "counts")

    sums = added.where("block is null").select("codes", "docs").mapInArrow(lambda x: _pair_rows(x, size), "a long, b long, docs long")
    best = np.zeros(ids, np.int64)
    for r in sums.groupBy("a").agg(F.max("docs").alias("n")).collect():
        best[r["a"]] = r["n"]
    fast = np.zeros(ids, np.int64)
    fast[list(plain)] = list(plain.values())
    tables = spark.sparkContext.broadcast((fast, np.maximum(best, fast)))

    kind = docs.schema[key].dataType.simpleString()
    answers = added.where("block is not null").withColumnsRenamed({"codes": "asked", "docs": "found"})
    rows = clustered(states.unionByName(answers, allowMissingColumns=True), ["block"])
    longs = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    schema = f"doc_id {kind}, " + ", ".join(f"{k} long" for k in longs) + ", groups_sha256 string, groups string"
    result = rows.mapInArrow(lambda batches: _looked_up(batches, tables, size), schema)

    known = spark.createDataFrame([(a, int(pair.same[a]), n) for a, n in plain.items()], "a long, b long, docs long")
    return result, sums.unionByName(known)


def _as_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column(0).to_pylist():
            vector = _unpacked(data)
            at = np.flatnonzero(vector)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(vector[at])], ["a", "n"])


def _pair_rows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for codes, docs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            codes = _from_steps(codes)
            yield pa.RecordBatch.from_arrays([pa.array(codes // size), pa.array(codes % size), pa.array(_unpacked(docs))], ["a", "b", "docs"])


def _looked_up(batches: Iterator[pa.RecordBatch], tables, size: int) -> Iterator[pa.RecordBatch]:
    """The texts of each block, with the counts of their links."""
    fast, best = tables.value
    for table, bounds in whole_groups(batches, ["block"]):
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            rows = table.slice(low, high - low)
            held = [k for k in range(rows.num_rows) if rows["codes"][k].is_valid][0]
            state = {k: rows[k][held].as_py() for k in _STATE}
            codes, docs = _from_steps(state["codes"]), _unpacked(state["docs"])
            for asked, found in zip(rows["asked"].to_pylist(), rows["found"].to_pylist(), strict=True):
                if asked is not None:
                    docs[np.searchsorted(codes, _from_steps(asked))] = _unpacked(found)
            values = _unpacked(state["values"])
            count = np.append(docs, fast)[values]
            highest = count == np.append(best[codes // size], best)[values]
            links, parts, sizes = (_unpacked(state[k]) for k in ("part_links", "parts", "text_parts"))
            sums = {"count_sum": _sums(_sums(count, links)[parts], sizes), "n_best": _sums(_sums(highest, links)[parts], sizes)}
            sums |= {k: _unpacked(state[k]) for k in ("n_a", "n_b", "n_groups", "n_links")}
            keys = rows["keys"].slice(held, 1).combine_chunks().flatten()
            digests = rows["digests"].slice(held, 1).combine_chunks().flatten()
            texts = rows["texts"].slice(held, 1).combine_chunks().flatten() if "texts" in rows.column_names else pa.nulls(len(keys), pa.string())
            columns = [keys, *(pa.array(sums[k], pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), digests, texts]
            names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
            yield pa.RecordBatch.from_arrays(columns, names)
