"""Which pairs of lines are looked at, and which are compared word by word."""

import random

import numpy as np
import pyarrow as pa

from catalog_marts.llm import lines


def test_pairs_are_all_rows_that_are_reached_nearest_first(monkeypatch):
    monkeypatch.setattr(lines, "PAIRS", 40)
    rng = random.Random(4)
    rows = sorted((rng.randrange(6), rng.randrange(1, 30)) for _ in range(150))
    group, n = (np.array(v) for v in zip(*rows, strict=True))
    want = {(y, x) for y in range(150) for x in range(y) if group[x] == group[y] and 100 * n[x] >= 80 * n[y]}
    found = [(a, b) for y, x in lines._pairs(lines._reach(group, n, 80)) for a, b in zip(y.tolist(), x.tolist(), strict=True)]
    assert len(found) == len(set(found)) and set(found) == want
    assert [y - x for y, x in found] == sorted(y - x for y, x in found)
    assert not list(lines._pairs(lines._reach(group[:0], n[:0], 80)))


def test_lines_are_in_order_whatever_their_keys():
    for doc in ([5, 5, 0, 7, 0], [-3, -3, 1 << 60, 7, 1 << 60]):
        line = [2, 2, 9, 0, 1]
        number = lines._in_order(np.array(doc), np.array(line)).tolist()
        places = list(zip(doc, line, strict=True))
        assert all((number[a] < number[b]) == (places[a] < places[b]) for a in range(5) for b in range(5))


def test_lines_that_share_little_are_not_compared_word_by_word(monkeypatch):
    rng, sets = random.Random(5), []
    for k in range(200):
        sets.append([1, *rng.sample(range(2, 1 << 40), 9)])
        if k % 20 == 0:
            sets.append(sets[-1][:9] + [7])
    head = np.array([[1, 0, doc, 0, doc * 11, 1, 10, 2] for doc in range(len(sets))]).T
    data = np.array([len(sets)]).tobytes() + head.astype(np.int64).tobytes() + np.array(sets).astype(np.uint64).tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([data], pa.binary())], ["part", "lines"])
    compared, common = [], lines._common

    def counted(*args):
        compared.append(len(args[-1]))
        return common(*args)

    monkeypatch.setattr(lines, "_common", counted)
    found = sorted(x["doc"] for out in lines._met(iter([batch]), 80) for x in out.to_pylist())
    similar = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    assert found == [y for y in range(len(sets)) if any(similar(set(sets[x]), set(sets[y])) for x in range(y))]
    assert len(found) == 10 and sum(compared) < 1000, "of 21,945 pairs"
