"""Vectors travel to a few blocks, however many cells their distances leave, and no link is lost."""

import numpy as np
import pytest

from catalog_marts.llm import multi_index
from catalog_marts.llm.multi_index import near_duplicate_vectors


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors_travel_to_few_blocks(spark, monkeypatch, kind):
    monkeypatch.setattr(multi_index, "CHUNK", 50)
    monkeypatch.setattr(multi_index, "PER_CELL", 4)  # 14 codewords of a half
    random = np.random.default_rng(2)
    points = random.normal(size=(600, 24))  # distances rule out few cells
    points[300:450] = points[:150] + 0.1 * random.normal(size=(150, 24))
    points[450:500] = points[0] + 0.05 * random.normal(size=(50, 24))
    points = points.astype("float32").astype(float)
    travelled, clustered = [], multi_index.clustered

    def counted(rows, *keys):
        travelled.append(rows.count())
        return clustered(rows, *keys)

    monkeypatch.setattr(multi_index, "clustered", counted)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(points)]
    got = near_duplicate_vectors(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label long")).collect()
    assert max(travelled) <= 2.7 * len(points)
    units = points / np.linalg.norm(points, axis=1, keepdims=True)
    links = units @ units.T >= 0.93
    component = np.arange(len(points))
    while ((least := np.where(links, component, len(points)).min(1)) != component).any():
        component = least
    np.fill_diagonal(links, False)
    assert links.sum() > 2500 and {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {
        i: (n, c) for i, (n, c) in enumerate(zip(links.sum(1).tolist(), component.tolist(), strict=True))
    }


def test_an_uneven_cell_is_cut_into_blocks_and_every_pair_of_blocks_meets_once():
    random = np.random.default_rng(1)
    units = multi_index._unit(random.normal(size=(800, 6)))
    book = multi_index.Codebooks(units, 6, -1.0)  # every cell is visited
    one, two, home = book.bounds(units)
    for blocks in (2, 3, 4, 7):
        borders = np.sort(home + random.random(800))[(np.arange(1, blocks) * 800) // blocks]
        own, visited = multi_index._visited(book, one, two, home + random.random(800), borders)
        pairs = np.zeros((blocks, blocks), int)
        for k in range(blocks):
            assert len(np.unique(visited[own == k], axis=0)) == 1
            pairs[k] = visited[own == k][0]
        assert (pairs + pairs.T == 1 - np.eye(blocks, dtype=int)).all()
