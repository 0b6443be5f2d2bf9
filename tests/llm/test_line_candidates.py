"""No candidate of a line is forgotten, and whole texts travel once."""

import numpy as np

from catalog_marts.llm.lines import deduplicate_lines
from catalog_marts.llm.text import hash_words


def test_a_farther_candidate_is_tried_when_the_closest_is_not_similar(spark):
    """Both meet the line at different words; bitmaps take the first one for an equal line."""
    words = [f"w{i}" for i in range(20_000)]
    data = np.frombuffer("\n".join(words).encode(), np.uint8)
    bits = hash_words(data, np.array([0, len(data)])).hashes & np.uint64(127)
    same = [[w for w, b in zip(words, bits.tolist(), strict=True) if b == k] for k in range(128)]
    rows, want = [], []
    for k in range(0, 120, 2):
        (q, x), (c, w) = same[k][:2], same[k + 1][:2]
        common = f"{c} {x} {w} " + " ".join(f"k{k}x{i}" for i in range(12))
        at = 10 * k
        rows += [(at + i, text) for i, text in enumerate([f"{common} a", f"{common} b c d e f g h", f"p{k} {x} {w}", f"{q} {c} z{k}", f"p{k} {q} {c}"])]
        want.append(at + 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gone = {r["doc_id"] for r in deduplicate_lines(docs, percent=50).where("n_removed > 0").collect()}
    assert gone >= set(want)


def test_texts_are_shuffled_once_and_shortened_without_python(spark):
    docs = spark.createDataFrame([(1, "a b c\nd\n\na b c"), (2, "d"), (3, None), (4, "")], "doc_id long, text string")
    found = deduplicate_lines(docs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "struct(doc_id" not in plan
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in found.collect()}
    assert got == {1: ("a b c\nd\n", 4, 1), 2: ("", 1, 1), 3: (None, 0, 0), 4: ("", 1, 0)}
