"""A line with many variants takes memory in proportion to their number, not to its square."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from catalog_marts.llm import lines
from catalog_marts.llm.sketch import Tally, coded, places


def test_pairs_of_variants_are_not_held_together():
    rng = random.Random(3)
    base = [f"b{i}" for i in range(22)]
    texts = [" ".join(w if rng.random() > 0.05 else f"c{rng.randrange(300)}" for w in base) for _ in range(1500)]
    batch = pa.RecordBatch.from_pydict({"doc": list(range(len(texts))), "text": texts})
    tally = Tally(lines.BITS)
    for found in lines._batches([batch]):
        tally.add(places(found.words, lines.BITS))

    class table:
        value = coded(tally.counts.astype(float))

    packed = pa.Table.from_batches(lines._postings(iter([batch]), table, 80, 1, lines.Tuning()))
    rows = len(lines._unpacked(packed)[0]["n"])
    tracemalloc.start()
    pairs, _ = lines._closest_in_part(packed, 80, lines.Tuning())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(np.unique(pairs[0])) > 900 and peak < 1000 * rows, f"{peak / rows:.0f} bytes a posting"
