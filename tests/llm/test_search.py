"""Exact top-k and near-duplicate vectors against brute force."""

import numpy as np
import pytest

from catalog_marts.llm import mtree, multi_index
from catalog_marts.llm.multi_index import near_duplicate_vectors
from catalog_marts.llm.mtree import MTree, top_products

SCHEMA = "vec_id long, embedding array<float>, label int, score int"


def brute(rows, every, k, scale):
    usable = [(i, np.floor(scale * np.array(v, float))) for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    out = []
    for i, q in usable:
        if i % every == 0:
            scores = sorted((-int(q @ v), j) for j, v in usable if j != i and len(v) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


def table(n=300, dim=6, seed=0):
    random = np.random.default_rng(seed)
    points = random.normal(size=(n, dim)).astype("float32").tolist()
    points[7] = points[3]
    return [(i, p, i % 3, 0) for i, p in enumerate(points)]


@pytest.mark.parametrize("tree", [16, 8192])
def test_top_products(spark, monkeypatch, tree):
    monkeypatch.setattr(mtree, "TREE", tree)
    monkeypatch.setattr(mtree, "QUERIES", 5)
    rows = table() + [
        (400, None, 1, 0), (420, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1, 0), (440, [float("nan")] * 6, 1, 0),
        (460, [], 1, 0), (480, [0.0] * 6, 1, 0), (None, [1.0] * 6, 1, 0), (500, [1.0, 2.0], 1, 0), (501, [2.0, 2.0], 1, 0),
    ]
    got = top_products(spark.createDataFrame(rows, SCHEMA), every=20, k=7, scale=64)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 20, 7, 64)


def test_ties_and_few_rows(spark):
    rows = [(20, [1.0, 1.0], 0, 0), *((i, [2.0, 0.0], 0, 0) for i in (5, 3, 9))]
    got = [tuple(r) for r in top_products(spark.createDataFrame(rows, SCHEMA), every=20, k=20, scale=1).orderBy("rank").collect()]
    assert got == [(20, 1, 3, 2), (20, 2, 5, 2), (20, 3, 9, 2)]
    assert top_products(spark.createDataFrame([], SCHEMA)).count() == 0


def test_tree_saves_distances():
    random = np.random.default_rng(1)
    centres = random.normal(size=(40, 8)) * 50
    points = np.floor(centres[random.integers(0, 40, 4000)] + random.normal(size=(4000, 8)))
    extra = np.append(points, np.sqrt((points**2).sum(1).max() - (points**2).sum(1))[:, None], axis=1)
    tree = MTree(extra, np.arange(4000))
    got = tree.search(points[5], -1, 3, -np.inf)
    assert sorted(s for s, _ in got) == sorted(np.sort(points @ points[5])[-3:].tolist())
    assert tree.computed < 2000


def duplicates(rows, cosine):
    def unit(v):
        return np.array(v, float) / np.linalg.norm(np.array(v, float))

    usable = [(n, i, unit(v), l) for n, (i, v, l, _) in enumerate(rows) if i is not None and l is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    parent = {i: i for i, *_ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = dict.fromkeys(range(len(rows)), 0)
    for n, i, u, l in usable:
        for m, j, v, k in usable:
            if n != m and l == k and len(u) == len(v) and u @ v >= cosine:
                links[n] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return sorted((str(i), links[n], str(None if i is None else find(i))) for n, (i, *_) in enumerate(rows))


@pytest.mark.parametrize("chunk", [8, 4096])
def test_near_duplicate_vectors(spark, monkeypatch, chunk):
    monkeypatch.setattr(multi_index, "CHUNK", chunk)
    monkeypatch.setattr(multi_index, "PER_CELL", 16)
    random = np.random.default_rng(3)
    rows = table(200, 8)
    for k in range(60):  # chains and a dense group
        base = np.array(rows[k % 12][1])
        rows.append((1000 - k, (base + 0.15 * random.normal(size=8)).astype("float32").tolist(), rows[k % 12][2], 0))
    rows += [(2000, rows[0][1], 0, 0), (2001, rows[0][1], 1, 0), (2001, rows[0][1], 0, 0), (2002, None, 0, 0), (2003, [0.0] * 8, 0, 0),
             (2004, rows[0][1], None, 0), (None, rows[0][1], 0, 0), (2005, [float("inf")] * 8, 0, 0), (2006, [1.0], 0, 0), (2007, [2.0], 0, 0)]
    got = near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in got) == duplicates(rows, 0.93)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_all_links_of_flat_clusters(spark, monkeypatch, dim=3):
    monkeypatch.setattr(multi_index, "PER_CELL", 1)  # about 30 codewords of a half
    random = np.random.default_rng(dim)
    plane = random.normal(size=(dim, 32))  # neighbours differ inside a subspace only
    centres = random.normal(size=(40, dim))
    points = centres[random.integers(0, 40, 900)] + 0.2 * random.normal(size=(900, dim))
    rows = [(i, p, i % 2, 0) for i, p in enumerate((points @ plane).astype("float32").tolist())]
    got = near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    units = np.array([r[1] for r in rows], float)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    labels = np.array([r[2] for r in rows])
    links = (units @ units.T >= 0.93) & (labels[:, None] == labels)
    np.fill_diagonal(links, False)
    assert {r["vec_id"]: r["n_links"] for r in got} == dict(enumerate(links.sum(1).tolist()))


def test_visits_reach_every_neighbour():
    random = np.random.default_rng(5)
    points = random.normal(size=(2000, 4)) @ random.normal(size=(4, 64))
    units = multi_index._unit(points + 0.02 * random.normal(size=points.shape))
    homes, cells = multi_index.Codebooks(units, 128, 0.93).visits(units)
    visits = [set(c) for c in cells]
    for q, x in np.argwhere(np.triu(units @ units.T >= 0.93, 1)):
        assert homes[x] in visits[q] or homes[q] in visits[x]
    assert all(h in c for h, c in zip(homes, visits, strict=True))


def test_no_vectors(spark):
    assert near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_blocks_of_queries_match_single_ones():
    random = np.random.default_rng(3)
    points = np.floor(random.normal(size=(900, 5)) * 8)
    points[100:140] = points[0]  # ties
    extra = np.append(points, np.sqrt((points**2).sum(1).max() - (points**2).sum(1))[:, None], axis=1)
    tree = MTree(extra, random.permutation(900))
    queries, own = points[::7], np.arange(0, 900, 7)
    least = np.where(own % 2 == 0, -np.inf, 100.0)
    scores, ids = tree.search_all(queries, own, 6, least)
    for q, o, low, s, i in zip(queries, own, least, scores, ids):
        every = sorted((-float(p[:-1] @ q), int(n)) for p, n in zip(tree.points, tree.ids) if n != o and p[:-1] @ q >= low)[:6]
        assert [(-a, b) for a, b in zip(s.tolist(), i.tolist()) if a > -np.inf] == every
        assert sorted(tree.search(q, o, 6, low)) == sorted((-a, b) for a, b in every)


def test_repeated_keys_are_separate_rows(spark, monkeypatch):
    monkeypatch.setattr(mtree, "TREE", 16)
    rows = [(7, [float(i), 1.0], 0, 0) for i in range(200)] + [(20, [1.0, 0.0], 0, 0)]
    got = top_products(spark.createDataFrame(rows, SCHEMA), every=20, k=3, scale=1)
    assert [tuple(r)[1:] for r in got.orderBy("rank").collect()] == [(1, 7, 199), (2, 7, 198), (3, 7, 197)]
