"""Exact top-k search by inner product in M-trees.

Inner products become distances by one more component that gives all stored vectors the same
length: with it the nearest vectors are those with the largest products. Vectors are dealt to the
nearest of some pivots, and each pivot's vectors form M-trees: pages of entries with a routing
vector, a covering radius and the distance to the page's own routing vector. A query first
searches the trees of its nearest pivot, then those of the pivots whose covering radius lets them
hold something as good as the k-th result so far. Inside a tree pages are taken best first, and
the triangle inequality over the stored distances saves most distance computations.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalog_marts.llm.groups import clustered, whole_groups
from catalog_marts.llm.vectors import finite, lists_of, rows_of
from catalog_marts.sources import scratch_copy

PAGE = 64  # entries of a page
TREE = 8192  # vectors of a tree
QUERIES = 4096  # that a task searches a tree for
PIVOTS = 256  # at most; taken from as many vectors with the smallest hash
_SLACK = 1e-9  # relative; bounds are rounded to the safe side


class MTree:
    """Pages in arrays: of each level the routing vectors, radii and distances to the parent."""

    def __init__(self, points: np.ndarray, ids: np.ndarray):
        """``points`` with the extra component, sorted into pages by recursive splits."""
        order = _paged(points, np.arange(len(points)))
        self.points, self.ids = points[order], ids[order]
        self.levels: list[dict[str, np.ndarray]] = []
        below, radii = self.points, np.zeros(len(points))
        while True:
            starts = np.arange(0, len(below), PAGE)
            centre = np.add.reduceat(below, starts) / np.diff(np.append(starts, len(below)))[:, None]
            page = np.arange(len(below)) // PAGE
            to_parent = np.linalg.norm(below - centre[page], axis=1)
            covering = np.maximum.reduceat(to_parent + radii, starts)
            self.levels.append({"centre": below, "radius": radii, "to_parent": to_parent})
            below, radii = centre, covering * (1 + _SLACK)
            if len(below) == 1:
                break
        self.root, self.radius = below[0], radii[0]

    def search(self, query: np.ndarray, own: int, k: int, least: float) -> list[tuple[float, int]]:
        """The ``k`` best (score, id) of one query."""
        scores, ids = self.search_all(query[None], np.array([own]), k, np.array([least]))
        return [(s, i) for s, i in zip(scores[0].tolist(), ids[0].tolist(), strict=True) if s > -np.inf]

    def search_all(self, queries: np.ndarray, own: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the ``k`` best rows of each query, best first; -inf where there are fewer.

        ``queries`` come without the extra component; results below ``least`` and rows with the id
        ``own`` are left out. Pages are taken best first over all queries, each with the queries
        that its bound does not rule out, so a page is compared with all of them at once.
        """
        lengths = (queries**2).sum(1)
        squares = lengths + float(self.points[0] @ self.points[0])
        slack = np.sqrt(_SLACK * (squares + 1))  # of distances, which come from products
        scores = np.full((len(queries), k), -np.inf)
        ids = np.full((len(queries), k), np.iinfo(np.int64).max)
        least, self.computed, pushed = least.astype(float), 0, 0
        floor, reach = least.copy(), _reach(squares, least)

        def apart(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
            products = queries[rows] @ centres[:, :-1].T
            return np.sqrt(np.maximum(lengths[rows][:, None] + (centres**2).sum(1) - 2 * products, 0))

        rows = np.arange(len(queries))
        distance = apart(rows, self.root[None])[:, 0]
        bound = np.maximum(distance - slack - self.radius, 0.0)
        heap = [(bound.min(), 0, len(self.levels) - 1, 0, rows, bound, distance)] if len(queries) else []
        while heap:
            _, _, level, page, rows, bound, distance = heapq.heappop(heap)
            open_ = bound <= reach[rows]
            if not open_.any():
                continue
            rows, distance = rows[open_], distance[open_]
            at = self.levels[level]
            entries = np.arange(page * PAGE, min((page + 1) * PAGE, len(at["centre"])))
            # |d(query, parent) - d(entry, parent)| bounds the distance without computing it
            nearest = np.abs(distance[:, None] - at["to_parent"][entries]) - at["radius"][entries] - slack[rows][:, None]
            wanted = nearest <= reach[rows][:, None]
            self.computed += int(wanted.sum())
            some = wanted.any(0)
            entries, wanted = entries[some], wanted[:, some]
            if not len(entries):
                continue
            if level:
                d = apart(rows, at["centre"][entries])
                low = np.maximum(d - slack[rows][:, None] - at["radius"][entries], 0.0)
                wanted &= low <= reach[rows][:, None]
                for j, entry in enumerate(entries.tolist()):
                    own_rows = np.flatnonzero(wanted[:, j])
                    if len(own_rows):
                        pushed += 1
                        bounds = low[own_rows, j]
                        heapq.heappush(heap, (bounds.min(), pushed, level - 1, entry, rows[own_rows], bounds, d[own_rows, j]))
                continue
            score = queries[rows] @ self.points[entries, :-1].T  # integers, exact in double precision
            wanted &= (score >= floor[rows][:, None]) & (self.ids[entries] != own[rows][:, None])
            better = np.flatnonzero(wanted.any(1))
            if not len(better):
                continue
            rows, wanted = rows[better], wanted[better]
            found = np.append(scores[rows], np.where(wanted, score[better], -np.inf), axis=1)
            names = np.append(ids[rows], np.where(wanted, self.ids[entries], np.iinfo(np.int64).max), axis=1)
            order = np.lexsort((names, -found), axis=-1)[:, :k]
            scores[rows], ids[rows] = np.take_along_axis(found, order, 1), np.take_along_axis(names, order, 1)
            floor[rows] = np.maximum(least[rows], scores[rows, -1])
            reach[rows] = _reach(squares[rows], floor[rows])
        return scores, ids


def _reach(square: np.ndarray, score: np.ndarray) -> np.ndarray:
    """The distance of a vector with this score, rounded up."""
    return np.sqrt(np.maximum(square - 2 * score, 0.0) + _SLACK * np.abs(square))


def _paged(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Rows in an order in which neighbours share pages: halves along the widest direction."""
    if len(rows) <= PAGE:
        return rows
    part = points[rows]
    far = part[np.argmax(((part - part[0]) ** 2).sum(1))]
    other = part[np.argmax(((part - far) ** 2).sum(1))]
    order = np.argsort(part @ (far - other), kind="stable")
    half = max(PAGE, (len(rows) // 2 + PAGE - 1) // PAGE * PAGE)
    return np.concatenate([_paged(points, rows[order[:half]]), _paged(points, rows[order[half:]])])


def _top(k: int):
    """The best results of each query of a group in the tree of the group."""
    def run(batches):
        for table, bounds in whole_groups(batches, ["dim", "pivot", "tree", "part"]):
            asks, ids, least = table["asks"].to_numpy(), table["id"].to_numpy(), table["least"].to_numpy()
            out = [[np.empty(0, np.int64)] * 3]
            for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                stored, queries = np.flatnonzero(~asks[low:high]), np.flatnonzero(asks[low:high])
                if not len(stored) or not len(queries):
                    continue
                matrix = rows_of(table["vector"].slice(low, high - low))
                points = matrix[stored]
                squares = (points**2).sum(1)
                points = np.append(points, np.sqrt(squares.max() - squares)[:, None], axis=1)
                tree = MTree(points, ids[low + stored])
                own = ids[low + queries]
                scores, found = tree.search_all(matrix[queries], own, k, least[low + queries])
                there = scores > -np.inf
                out.append([np.broadcast_to(own[:, None], scores.shape)[there], found[there], scores[there].astype(np.int64)])
            columns = [pa.array(np.concatenate(x)) for x in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])
    return run


def top_products(
    vectors: DataFrame, every: int = 50, k: int = 20, scale: float = 64, key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """For each row with a key divisible by ``every`` the ``k`` other rows with the largest products.

    Components become ``floor(scale * x)`` in double precision; the score is the inner product of
    the integers, exact while it is below 2 ** 53. Returns ``query_id``, ``rank`` from 1,
    ``vec_id`` and ``score``; equal scores rank by key; fewer rows if there are fewer.

    Null or empty vectors, vectors with null or non-finite components and rows with a null key
    take no part; vectors of different lengths are not compared. A row is never a result of a
    query with its own key; rows that repeat a key are separate results otherwise, and a repeated
    query key is asked once for each row, from which the best ``k`` rows are taken.

    ``PIVOTS`` vectors at most and the radii around them are known to every task. Trees hold
    ``TREE`` vectors and are searched for ``QUERIES`` queries at a time, so no task holds more.
    """
    scaled = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * scale).cast("double"))
    usable = vectors.where(F.col(key).isNotNull() & finite(F.col(vector)))
    stored = usable.select(F.col(key).cast("long").alias("id"), scaled.alias("vector"))
    stored = scratch_copy(stored.withColumn("dim", F.size("vector")), "vectors")
    n = stored.count()
    sample = stored.orderBy(F.xxhash64("id", "vector"), "id").limit(min(PIVOTS, 1 + n // TREE)).select("dim", "vector").toArrow()
    pivots = {}
    for dim in set(sample["dim"].to_pylist()):
        pivots[dim] = rows_of(sample.filter(pa.array(sample["dim"].to_numpy() == dim))["vector"])
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def dealt(batches):
        for batch in batches:
            lengths = batch.column("dim").to_numpy()
            for dim in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == dim))
                matrix = rows_of(part.column("vector"))
                centres = shared.value.get(dim, np.zeros((1, dim)))
                squares = (matrix**2).sum(1)[:, None] - 2 * matrix @ centres.T + (centres**2).sum(1)
                pivot = squares.argmin(1)
                apart = np.linalg.norm(matrix - centres[pivot], axis=1)
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), part.column("dim"), lists_of(matrix), pa.array(pivot), pa.array(apart),
                    pa.array(np.linalg.norm(matrix, axis=1)),
                ], ["id", "dim", "vector", "pivot", "apart", "length"])

    stored = scratch_copy(stored.mapInArrow(
        dealt, "id long, dim int, vector array<double>, pivot long, apart double, length double"
    ), "dealt")
    group = ["dim", "pivot"]
    regions = stored.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.max("apart").alias("radius"), F.max("length").alias("length")
    )
    regions = regions.withColumn("trees", F.ceil(F.col("n") / TREE)).drop("n")
    regions = scratch_copy(regions, "regions")  # one row per pivot at most, and per length of vectors
    known = {}
    for row in regions.collect():
        known.setdefault(row["dim"], []).append((row["pivot"], row["radius"], row["length"]))
    known = vectors.sparkSession.sparkContext.broadcast(known)
    queries = stored.where(F.col("id") % every == 0).select("id", "dim", "vector", "pivot")

    def searched(queries: DataFrame) -> DataFrame:
        """``queries`` with a ``pivot`` and ``least``, in all trees of that pivot."""
        parts = queries.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("parts"))
        size = scratch_copy(regions.select(*group, "trees").join(parts, group), "sizes")
        columns = [*group, "tree", "part", "id", "asks", "least", "vector"]
        held = stored.join(size, group).withColumns({
            "tree": F.pmod(F.xxhash64("id", "vector", F.lit("tree")), F.col("trees")), "asks": F.lit(False), "least": F.lit(0.0),
        }).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        asked = queries.join(size, group).withColumns({
            "part": F.pmod(F.xxhash64("id", "vector", F.lit("part")), F.col("parts")), "asks": F.lit(True),
        }).withColumn("tree", F.explode(F.sequence(F.lit(0).cast("long"), F.col("trees") - 1)))
        both = clustered(held.select(*columns).unionByName(asked.select(*columns)), [*group, "tree", "part"])
        return both.mapInArrow(_top(k), "query_id long, vec_id long, score long")

    def best(results: DataFrame) -> DataFrame:
        ranks = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return results.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)

    near = scratch_copy(best(searched(queries.withColumn("least", F.lit(float("-inf"))))), "near")
    least = near.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("_l"))
    waiting = queries.withColumnRenamed("pivot", "home").join(least, "id", "left")
    waiting = waiting.withColumn("least", F.coalesce("_l", F.lit(float("-inf")))).drop("_l")

    def further(batches):
        for batch in batches:
            lengths = batch.column("dim").to_numpy()
            for dim in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == dim))
                matrix, home = rows_of(part.column("vector")), part.column("home").to_numpy()
                least = part.column("least").to_numpy()
                size = np.linalg.norm(matrix, axis=1)
                for pivot, radius, length in known.value[dim]:
                    centre = shared.value.get(dim, np.zeros((1, dim)))[pivot]
                    # within the radius no product is larger than q*c + |q|*r, nor than |q| times the length
                    most = np.minimum(matrix @ centre + size * radius, size * length) * 1.0
                    rows = np.flatnonzero((most + _SLACK * (1 + np.abs(most)) >= least) & (home != pivot))
                    if len(rows):
                        chosen = part.take(pa.array(rows))
                        yield pa.RecordBatch.from_arrays([
                            chosen.column("id"), chosen.column("dim"), chosen.column("vector"),
                            pa.array(np.full(len(rows), pivot)), chosen.column("least"),
                        ], ["id", "dim", "vector", "pivot", "least"])

    rest = scratch_copy(waiting.mapInArrow(
        further, "id long, dim int, vector array<double>, pivot long, least double"
    ), "further")
    both = near.drop("rank").unionByName(searched(rest))
    return best(both).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
