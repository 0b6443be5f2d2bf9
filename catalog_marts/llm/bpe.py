"""Byte-level BPE by prefix dynamic programming.

BPE leaves exactly one segmentation of a string of bytes, and every prefix of that segmentation
is the segmentation of a prefix of the string. So one number per position is enough: the last
token of the encoding of the bytes before it. A token ``t`` that ends at a position is that last
token if and only if it may follow the last token of the position where ``t`` begins, which the
merge ranks of the two tokens decide. Appending bytes only adds positions, and an edit recomputes
positions from the edit until the old values return.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from catalog_marts.llm.held import held, tidied

KEEP_PIECES, KEEP_BYTES, KEEP_PAIRS = 400_000, 64, 2_000_000  # bounds of a worker's caches
LONG_TEXT = 1 << 20  # characters from which a text is split step by step
STEP = 100_000  # pieces of a long text at a time
ROWS = 512  # texts that a task holds the ids and bytes of


class Vocabulary:
    """Tokens of a rank file: one token in base64 and its rank per line."""

    def __init__(self, rank_file: bytes):
        ranks = {}
        for line in rank_file.splitlines():
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for byte {missing[0]}")
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * self.size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, ranks))
        self._left = list(range(self.size))  # the two tokens that a token was merged from
        self._right = list(range(self.size))
        self._merged: dict[int, int] = {}
        self._memo: dict[int, bool] = {}
        for rank, token in enumerate(self.tokens):
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None and a < rank > b and self._border_holds(a, b):
                    self._left[rank], self._right[rank] = a, b
                    self._merged[a * self.size + b] = rank
                    break
        self.endings: dict[bytes, int] = {}  # every ending of a token, and its rank or -1
        for token in ranks:
            for start in range(len(token)):
                self.endings.setdefault(token[start:], ranks.get(token[start:], -1))

    def _border_holds(self, a: int, b: int) -> bool:
        """Undo the merges at the border, latest first; no earlier merge may cross it."""
        merged, size, limit = self._merged, self.size, self.size
        while True:
            if merged.get(a * size + b, limit) < limit:
                return False
            undo_left = a > b
            for _ in range(2):  # a single byte can't be undone; then the other side's turn
                if undo_left and self._left[a] != a:
                    limit, a = a, self._right[a]
                    break
                if not undo_left and self._right[b] != b:
                    limit, b = b + 1, self._left[b]
                    break
                limit = a if undo_left else b + 1
                undo_left = not undo_left
            else:
                return True

    def may_follow(self, a: int, b: int) -> bool:
        """Does the encoding of the bytes of ``a`` and ``b`` keep these two tokens?"""
        key = a * self.size + b
        known = self._memo.get(key)
        if known is None:
            if len(self._memo) >= KEEP_PAIRS:
                self._memo.clear()
            known = self._memo[key] = self._border_holds(a, b)
        return known


class PrefixTable:
    """The encoding of every prefix of ``data``; ``data`` is a single piece, without splitting."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Exact encoding of the longer string; earlier positions are not touched."""
        self.data += more
        for end in range(len(self.last), len(self.data) + 1):
            self.last.append(self._at(end))

    def _at(self, end: int) -> int:
        endings, may_follow, data, last = self.vocabulary.endings, self.vocabulary.may_follow, self.data, self.last
        for start in range(end - 1, -1, -1):
            token = endings[data[start:end]]
            if token >= 0 and (start == 0 or may_follow(last[start], token)):
                return token
        raise AssertionError("a vocabulary with all single bytes encodes everything")

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` for ``data[start:end]``; returns how many positions were recomputed.

        A position depends on at most ``longest`` positions before it, so once that many in a
        row have their old values, all that follow do.
        """
        old, shift = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last, same = old[: start + 1], 0
        for at in range(start + 1, len(self.data) + 1):
            token = self._at(at)
            self.last.append(token)
            same = same + 1 if at > start + len(new) and old[at - shift] == token else 0
            if same >= self.vocabulary.longest:
                self.last += old[at - shift + 1 :]
                return at - start
        return len(self.data) - start

    def tokens(self, end: int | None = None) -> list[int]:
        """Encoding of the first ``end`` bytes, of all bytes if left out."""
        at, found = len(self.data) if end is None else end, []
        while at:
            found.append(self.last[at])
            at -= len(self.vocabulary.tokens[self.last[at]])
        return found[::-1]


class Encoder(dict):
    """Pieces to the bytes of their ids; keeps short pieces that it has met, up to a bound."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        super().__init__()
        self.vocabulary, self.split = vocabulary, regex.compile(pattern)

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode()
        token = self.vocabulary.ranks.get(data)
        ids = PrefixTable(self.vocabulary, data).tokens() if token is None else [token]
        coded = np.array(ids, "<u4").tobytes()
        if len(data) <= KEEP_BYTES:
            if len(self) >= KEEP_PIECES:
                self.clear()
            self[piece] = coded
        return coded

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if len(text) < LONG_TEXT:
            return b"".join(map(self.__getitem__, self.split.findall(text)))
        found, coded = (m.group() for m in self.split.finditer(text)), []
        while step := list(islice(found, STEP)):
            coded.append(b"".join(map(self.__getitem__, step)))
        return b"".join(coded)

    def decode(self, ids: bytes | None) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def _encoder(rank_file: bytes, pattern: str) -> Encoder:
    return held(("bpe", hash(rank_file), pattern), lambda: Encoder(Vocabulary(rank_file), pattern))


def _mapped(df: DataFrame, key: str, column: str, outs: dict[str, str], rank_file, pattern: str) -> DataFrame:
    """``key`` and a binary column per entry of ``outs``, whose methods are applied one after the other."""
    kind = df.schema[key].dataType.simpleString()

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(rank_file.value, pattern)
        works = [getattr(encoder, what) for what in outs.values()]
        for batch in batches:
            for part in (batch.slice(low, ROWS) for low in range(0, batch.num_rows, ROWS)):
                values, columns = part.column(1).to_pylist(), [part.column(0)]
                for work in works:
                    values = [work(x) for x in values]
                    columns.append(pa.array(values, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, [key, *outs])

    return df.select(key, column).mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"`{out}` binary" for out in outs))


def bpe_encode(
    docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text", decoded: bool = False
) -> DataFrame:
    """Token ids of every whole text.

    ``ranks`` is the path of a rank file that the driver can read (the vocabulary, about 1 MB,
    goes to the executors), ``pattern`` splits a text into the pieces that are encoded one by
    one. Returns ``key`` and ``ids``, binary: unsigned 32-bit integers, little-endian. With
    ``decoded`` the ids are decoded again by the same task, and their bytes come out as
    ``decoded``. Special tokens have no meaning: their strings are ordinary text.

    Null and empty texts have no ids (an empty value). Rows are independent: a null key is kept,
    repeated rows come out as often as they went in, other columns are ignored whatever their
    names, an empty table gives an empty table. A text of any length is encoded whole.
    """
    with open(ranks, "rb") as f:
        rank_file = docs.sparkSession.sparkContext.broadcast(f.read())
    outs = {"ids": "encode", "decoded": "decode"} if decoded else {"ids": "encode"}
    return _mapped(docs, key, text, outs, rank_file, pattern)


def bpe_decode(encoded: DataFrame, ranks: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """The bytes that ``ids`` stand for: ``key`` and ``decoded``, binary. Null ids: no bytes."""
    with open(ranks, "rb") as f:
        rank_file = encoded.sparkSession.sparkContext.broadcast(f.read())
    return _mapped(encoded, key, "ids", {"decoded": "decode"}, rank_file, pattern)
