"""Near-duplicate vectors by an inverted multi-index.

Two codebooks, one for each half of the vectors, form a grid of cells; a vector lies in the cell
of its nearest codewords. A vector visits the cells of which a lower bound of their distance, the
sum of the two halves' bounds, is at most the squared distance of vectors exactly at the limit of
similarity, so no cell that can hold a neighbour is left out. What stands in the cells visited is
compared, first in single precision with room for its error, then exactly.

The cells of a label stand in blocks of neighbouring cells. A vector travels to its own block and
once to each block with a cell to visit, not to each cell; of two blocks that can hold neighbours of
each other one is enough to meet in. A label has few blocks, each as large as a task can hold, so
what travels stays a few times the vectors, also where distances rule out no cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_marts.llm.components import connected_components
from catalog_marts.llm.groups import clustered, whole_groups
from catalog_marts.llm.held import release, tidied
from catalog_marts.llm.vectors import finite, packed, rows_of
from catalog_marts.sources import scratch_copy

SAMPLE = 8192  # vectors that the codebooks are fitted on
PER_CELL = 512  # vectors for which a cell is planned
MAX_WORDS = 128  # of a codebook
CHUNK = 4096  # vectors of a label from which it has several blocks
SPREAD = 4  # blocks of a label, if one task could hold them all: each vector travels 2.5 times
HELD = 1 << 24  # components of a block's vectors: 64 MB in single precision
TILE = 1024  # vectors compared with as many others at once


class Codebooks:
    """The two codebooks for vectors of one length, and how far a vector has to look."""

    def __init__(self, sample: np.ndarray, words: int, cosine: float):
        random = np.random.default_rng(7)
        self.half = sample.shape[1] // 2
        self.books = [_fit(part, words, random) for part in self.split(sample)]
        self.reach = max(0.0, 2 * (1 - cosine)) + 1e-9  # squared distance at the limit; rounding

    @classmethod
    def flat(cls) -> Codebooks:
        """One cell, for lengths without a sample."""
        books = cls.__new__(cls)
        books.half, books.books, books.reach = 0, [np.zeros((1, 0))] * 2, 0.0
        return books

    def split(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return unit[:, : self.half], unit[:, self.half :]

    @property
    def cells(self) -> int:
        return len(self.books[0]) * len(self.books[1])

    def bounds(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bounds of the distance to the codewords of either half, and own cells."""
        (one, first), (two, second) = (_bounds(x, book) for x, book in zip(self.split(unit), self.books, strict=True))
        return one, two, first * len(self.books[1]) + second

    def within(self, one: np.ndarray, two: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Which of these cells each vector has to visit."""
        width = len(self.books[1])
        return one[:, cells // width] + two[:, cells % width] <= self.reach

    def visits(self, unit: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
        """Own cell, and the cells to visit, nearest first (the own one leads), of each vector."""
        one, two, homes = self.bounds(unit)
        found = []
        for a, b, home in zip(one, two, homes.tolist(), strict=True):
            cells = np.flatnonzero(self.within(a[None], b[None], np.arange(self.cells))[0])
            near = (a[:, None] + b).ravel()[cells]
            found.append(cells[np.lexsort((near, cells != home))].tolist())
        return homes, found


def _fit(part: np.ndarray, words: int, random: np.random.Generator) -> np.ndarray:
    book = part[random.permutation(len(part))[:words]].copy()
    for _ in range(10):
        nearest = _squares(part, book).argmin(1)
        sums = np.zeros_like(book)
        np.add.at(sums, nearest, part)
        count = np.bincount(nearest, minlength=len(book))
        book[count > 0] = sums[count > 0] / count[count > 0, None]
    return np.unique(book, axis=0)


def _squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return (x**2).sum(1)[:, None] - 2 * x @ book.T + (book**2).sum(1)


def _bounds(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances to the borders with the cells of other codewords; the nearest codeword.

    Nothing in such a cell is closer. Codewords too close to tell their border count as 0 away.
    """
    squares = _squares(x, book)
    nearest = squares.argmin(1)
    between = np.sqrt(np.maximum(_squares(book, book), 0))[nearest]
    beyond = squares - squares[np.arange(len(x)), nearest][:, None]
    return (np.maximum(beyond, 0) / (2 * np.where(between > 1e-4, between, np.inf))) ** 2, nearest


def _unit(matrix: np.ndarray) -> np.ndarray:
    matrix = matrix / np.abs(matrix).max(1, keepdims=True)  # squares neither overflow nor vanish
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _by_length(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    lengths = batch.column("dim").to_numpy()
    for dim in np.unique(lengths):
        yield batch.filter(pa.array(lengths == dim))


def _blocks(n: int, dim: int) -> int:
    """How many blocks the vectors of a label and length are cut into."""
    return max(-(-n * dim // HELD), min(SPREAD, -(-n // CHUNK)))


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where blocks end, from the vectors of each cell: a cell, and which share of its vectors."""
    for table, bounds in whole_groups(batches, ["label", "dim"]):
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            home, n = (table[c].to_numpy()[low:high] for c in ("home", "n"))
            dim, ends = table["dim"][low].as_py(), np.cumsum(n)
            blocks = _blocks(int(ends[-1]), dim)
            cuts = np.arange(1, blocks) * (ends[-1] / blocks)
            at = np.searchsorted(ends, cuts, side="right")
            borders = home[at] + (cuts - ends[at] + n[at]) / n[at]
            yield pa.RecordBatch.from_arrays(
                [table["label"].combine_chunks()[low : low + 1], pa.array([dim], pa.int32()), pa.array([borders], pa.list_(pa.float64()))],
                ["label", "dim", "borders"],
            )


def _visited(book: Codebooks, one: np.ndarray, two: np.ndarray, place: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Own block of each vector, and the other blocks that it visits; of two blocks one visits."""
    own, blocks = np.searchsorted(borders, place, side="right"), len(borders) + 1
    first, last = np.append(0, borders.astype(np.int64)), np.append(borders.astype(np.int64), book.cells - 1)
    ahead = (own[:, None] - np.arange(blocks)) % blocks
    visited = (2 * ahead < blocks) & (ahead > 0) | (2 * ahead == blocks) & (own[:, None] > np.arange(blocks))
    for block, (a, b) in enumerate(zip(first, last, strict=True)):
        some = np.flatnonzero(visited[:, block])
        for rows in np.array_split(some, 1 + len(some) * int(b - a + 1) // (1 << 22)):
            visited[rows, block] = book.within(one[rows], two[rows], np.arange(a, b + 1)).any(1)
    return own, visited


class _Block:
    """The vectors of a block, and their links with each other and with its visitors."""

    def __init__(self, raw: np.ndarray, key, id, copies, home, book: Codebooks | None, cosine: float):
        self.raw, self.key, self.id, self.copies, self.home, self.book, self.cosine = raw, key, id, copies, home, book, cosine
        self.low = np.float32(cosine - (raw.shape[1] + 8) * 2.0**-23)  # room for the error of single precision
        self.unit = np.concatenate([_unit(raw[a : a + TILE].astype(float)).astype(np.float32) for a in range(0, len(raw), TILE)])
        self.n, self.reached, self.links = np.zeros(len(raw)), id.copy(), []

    def among(self) -> None:
        for low in range(0, len(self.raw), TILE):
            rows = slice(low, low + TILE)
            self._meet(_unit(self.raw[rows].astype(float)), self.copies[rows], self.n[rows], self.reached[rows], low)

    def visited(self, raw: np.ndarray, id: np.ndarray, copies: np.ndarray) -> np.ndarray:
        """Links of visitors, counted."""
        n, reached = np.zeros(len(raw)), id.copy()
        for low in range(0, len(raw), TILE):
            rows = slice(low, low + TILE)
            self._meet(_unit(raw[rows].astype(float)), copies[rows], n[rows], reached[rows])
        return n

    def _meet(self, unit: np.ndarray, copies: np.ndarray, n: np.ndarray, reached: np.ndarray, begin: int = -1) -> None:
        """``begin``: where the vectors stand themselves; they meet those after them."""
        if self.book:
            one, two, _ = self.book.bounds(unit)
        single = unit.astype(np.float32)
        for low in range(max(begin, 0), len(self.raw), TILE):
            x, rows = slice(low, low + TILE), np.arange(len(unit))
            if self.book:
                rows = np.flatnonzero(self.book.within(one, two, np.unique(self.home[x])).any(1))
            if not len(rows):
                continue
            near = (single if len(rows) == len(unit) else single[rows]) @ self.unit[x].T
            if near.max() < self.low:
                continue
            i, j = np.nonzero(near >= self.low)
            if low == begin:
                i, j = (v[j > rows[i]] for v in (i, j))
            i = rows[i]
            link = self._linked(unit, i, j, x)
            i, j = i[link], j[link]
            if not len(i):
                continue
            n += np.bincount(i, self.copies[x][j], len(unit))
            self.n[x] += np.bincount(j, copies[i], len(self.id[x]))
            self._connect(reached, i, self.reached[x], j)

    def _linked(self, unit: np.ndarray, i: np.ndarray, j: np.ndarray, x: slice) -> np.ndarray:
        of, at = np.unique(j, return_inverse=True)
        other = _unit(self.raw[x][of].astype(float))
        if 8 * len(i) > len(unit) * len(of):
            return (unit @ other.T)[i, at] >= self.cosine
        parts = np.array_split(np.arange(len(i)), 1 + len(i) * unit.shape[1] // (1 << 20))
        return np.concatenate([np.einsum("ij,ij->i", unit[i[p]], other[at[p]]) for p in parts]) >= self.cosine

    def _connect(self, a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> None:
        """Linked rows get the smallest id that either has; what that changes is a link to give on."""
        of_a, of_b = np.unique(i), np.unique(j)
        before = np.concatenate([a[of_a], b[of_b]])
        while (a[i] != b[j]).any():
            least = np.minimum(a[i], b[j])
            np.minimum.at(a, i, least)
            np.minimum.at(b, j, least)
        after = np.concatenate([a[of_a], b[of_b]])
        changed = np.unique(np.stack([before, after])[:, before != after], axis=1)
        if changed.size:
            self.links.append(changed)

    def found(self, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        """The links to give on so far, and these counts."""
        a, b = np.concatenate([*self.links, np.empty((2, 0), np.int64)], axis=1)
        self.links = []
        key, n = key[n > 0], np.rint(n[n > 0]).astype(np.int64)
        none = [pa.nulls(len(v), pa.int64()) for v in (key, a)]
        columns = [pa.concat_arrays([pa.array(v), none[0]]) for v in (a, b)] + [pa.concat_arrays([none[1], pa.array(v)]) for v in (key, n)]
        return pa.RecordBatch.from_arrays(columns, ["a", "b", "key", "n"])


def _compare(books, cosine: float):
    """Links of the vectors of a block with each other and with its visitors, counted; and links
    that connect them. The rows of a block come first, its visitors pass by.
    """
    @tidied
    def run(batches):
        release()
        block, where, own = None, None, []

        def settled() -> _Block:
            raw = np.concatenate([rows_of(part.column("vector")) for part in own])
            columns = (np.concatenate([part.column(c).to_numpy() for part in own]) for c in ("key", "id", "copies", "home"))
            result = _Block(raw, *columns, books.value.get(raw.shape[1]), cosine)
            own.clear()
            result.among()
            return result

        for batch in batches:
            names = ["label", "dim", "block", "visitor"]
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names])
            starts = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0)))[: keys.shape[1]]
            for low, high in zip(starts, np.append(starts[1:], batch.num_rows), strict=False):
                part, (*at, visitor) = batch.slice(low, high - low), keys[:, low].tolist()
                if at != where:
                    block = block or (settled() if own else None)
                    if block:
                        yield block.found(block.key, block.n)
                    block, where = None, at
                if not visitor:
                    own.append(part)
                    continue
                if block is None and own:
                    block = settled()
                if block is not None:
                    n = block.visited(rows_of(part.column("vector")), part.column("id").to_numpy(), part.column("copies").to_numpy())
                    yield block.found(part.column("key").to_numpy(), n)
        block = block or (settled() if own else None)
        if block:
            yield block.found(block.key, block.n)
    return run


def near_duplicate_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = 0.93,
) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Two rows are linked if their labels are equal and the cosine of their vectors, in double
    precision, is ``cosine`` or more. Null labels, null, empty or all-zero vectors, vectors with null
    or non-finite components and rows with a null key link with nothing; vectors of different
    lengths don't either. Equal vectors of a label are one vector with a number of copies up to
    the end, so copies cost nothing; each counts as a link of every other. Rows that repeat a key
    share a component. ``component_id`` is the smallest key reachable (the own key without links,
    null for a null key); ``kept`` marks the rows whose key it is, and rows with a null key.

    The codebooks are fitted on ``SAMPLE`` vectors, the ones with the smallest hash; every vector
    is indexed, and every link is found. The fewer cells the vectors' distances rule out, the more
    are visited: all of them, in the worst case, so that all pairs of a label are compared, each
    once. Of a block only counts and connecting links come out. Vectors of floats travel as such.
    """
    exact = packed(F.col(vector))
    single = vectors.schema[vector].dataType.simpleString() == "array<float>"
    named = vectors.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), (F.col(vector) if single else exact).alias("vector")
    )
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & finite(F.col("vector"))
    usable = usable & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False))
    named = named.withColumn("key", F.when(usable, F.xxhash64("label", packed(F.col("vector")))))
    distinct = named.where("key is not null").groupBy("key").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector")
    )
    distinct = scratch_copy(distinct.withColumn("dim", F.size("vector")), "vectors")

    n = distinct.count()
    sample = distinct.orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("dim", "vector").toArrow()
    words = int(min(MAX_WORDS, max(2, np.ceil(np.sqrt(n / PER_CELL)))))
    books = {}
    for dim in np.unique(sample["dim"].to_numpy()).tolist():
        same = rows_of(sample.filter(pa.array(sample["dim"].to_numpy() == dim))["vector"])
        books[dim] = Codebooks(_unit(same.astype(float)), words, cosine)
    books = vectors.sparkSession.sparkContext.broadcast(books)

    large = distinct.groupBy("label", "dim").count().where(f"count > {CHUNK} or count * dim > {HELD}")
    large = {tuple(row) for row in large.select("label", "dim").collect()}  # of many vectors each
    large = vectors.sparkSession.sparkContext.broadcast(large)

    def placed(batches):
        """Vectors of a length with their bounds; a length that the sample lacks has one cell."""
        for batch in batches:
            for same in _by_length(batch):
                for part in (same.slice(low, TILE) for low in range(0, len(same), TILE)):
                    book, none = books.value.get(dim := part.column("dim")[0].as_py()), np.zeros((len(part), 1))
                    bounds = book.bounds(_unit(rows_of(part.column("vector")).astype(float))) if book else (none, none, np.zeros(len(part), np.int64))
                    labels = part.column("label").to_numpy()
                    yield part, dim, book, labels, bounds

    def homes(batches):
        for _, dim, _, labels, (_, _, home) in placed(batches):
            found, n = np.unique(np.stack([labels, home]), axis=1, return_counts=True)
            some = np.array([(label, dim) in large.value for label in found[0].tolist()], bool)
            dims = pa.array(np.full(int(some.sum()), dim), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(found[0][some]), dims, pa.array(found[1][some]), pa.array(n[some])], ["label", "dim", "home", "n"])

    borders = {}
    if large.value:
        sizes = distinct.select("label", "dim", "vector").mapInArrow(homes, "label long, dim int, home long, n long")
        sizes = sizes.groupBy("label", "dim", "home").agg(F.sum("n").alias("n"))
        rows = clustered(sizes, ["label", "dim"], ["home"]).mapInArrow(_borders, "label long, dim int, borders array<double>").toArrow()
        borders = {(r["label"], r["dim"]): np.array(r["borders"]) for r in rows.to_pylist() if r["borders"]}
    borders = vectors.sparkSession.sparkContext.broadcast(borders)
    flat = Codebooks.flat()

    def index(batches):
        for part, dim, book, labels, (one, two, home) in placed(batches):
            place = home + (part.column("key").to_numpy() & 0xFFFFF) / (1 << 20)  # vectors of a cell are cut by hash
            own, rows, blocks = np.zeros(len(part), np.int64), [], []
            for label in np.unique(labels).tolist():
                if (label, dim) in borders.value:
                    some = np.flatnonzero(labels == label)
                    own[some], visited = _visited(book or flat, one[some], two[some], place[some], borders.value[label, dim])
                    row, block = np.nonzero(visited)
                    rows.append(some[row])
                    blocks.append(block)
            rows, blocks = np.concatenate([np.arange(len(part)), *rows]), np.concatenate([own, *blocks])
            by = np.argsort(rows, kind="stable")
            ends = np.append(0, np.cumsum(np.bincount(rows, minlength=len(part))))
            meets = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(blocks[by], pa.int32()))
            columns = [*(part.column(c) for c in ("key", "id", "copies", "label", "dim", "vector")), pa.array(home), meets]
            yield pa.RecordBatch.from_arrays(columns, ["key", "id", "copies", "label", "dim", "vector", "home", "meets"])

    kind = distinct.schema["vector"].dataType.simpleString()
    columns = ["key", "id", "copies", "label", "dim", "vector"]
    indexed = distinct.select(*columns).mapInArrow(
        index, f"key long, id long, copies long, label long, dim int, vector {kind}, home long, meets array<int>"
    )
    meet = indexed.select(*columns, "home", F.posexplode("meets").alias("visitor", "block")).withColumn("visitor", F.col("visitor") > 0)
    meet = clustered(meet, ["label", "dim", "block"], ["visitor", "home"])
    found = scratch_copy(meet.mapInArrow(_compare(books, cosine), "a long, b long, key long, n long"), "found")

    counts = found.where("key is not null").groupBy("key").agg(F.sum("n").alias("_n"))
    counts = scratch_copy(distinct.select("key", F.col("id").alias("first"), "copies").join(counts, "key", "left"), "counts")
    rows = named.select("id", "key").join(counts, "key", "left")
    several = rows.where("first is not null").groupBy("id").agg(F.min("first").alias("a"), F.max("first").alias("z"))
    links = found.where("a is not null").select("a", "b")
    links = links.unionByName(rows.where("first <> id").join(several.where("a <> z"), "id").select("a", F.col("first").alias("b")))
    links = links.unionByName(rows.where("first = id").join(several.where("a <> z"), "id").select("a", F.col("first").alias("b")))
    component = connected_components(links)
    rows = rows.withColumn("_id", F.coalesce("first", "id"))
    rows = rows.join(component.select(F.col("id").alias("_id"), "component"), "_id", "left")
    reached = F.when(F.col("id").isNotNull(), F.coalesce("component", "_id"))
    return rows.select(
        F.col("id").alias(key), F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias("_m"), "copies", reached.alias("component_id")
    ).select(
        key, (F.col("_m") + F.coalesce(F.col("copies") - 1, F.lit(0))).alias("n_links"), "component_id",
        F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)).alias("kept"),
    )
