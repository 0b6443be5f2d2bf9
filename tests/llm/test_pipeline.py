"""The pipeline's stages one by one against plain Python, and its rows against those of the stages."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from catalog_marts.llm.bpe import Vocabulary
from catalog_marts.llm.queries import RANKS
from catalog_marts.sources import scratch_copy

SF = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"


def lowered(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m.group().lower(), text))


def test_stages(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    docs, results = spark.read.parquet(f"{SF}/documents.parquet"), {}
    given = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch_copy(stage(spark, docs, SF), name)
        results[name] = docs
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == given
    texts = {n: {r["doc_id"]: r["text"] for r in f.collect()} for n, f in results.items() if n != "byte_bpe"}

    before = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    clean = [i for i, toxic in labels.items() if toxic == 0]
    assert np.mean([i in texts["toxicity"] for i in clean]) > 0.9
    toxic = [i for i, t in labels.items() if t == 1]
    assert np.mean([i in texts["toxicity"] for i in toxic]) < 0.4

    earlier, want = [], {}
    for i in sorted(texts["toxicity"]):
        kept = []
        for line in before[i].split("\n"):
            words = set(lowered(line))
            if not words or not any(100 * len(words & e) >= 80 * len(words | e) for e in earlier):
                kept.append(line)
            if words:
                earlier.append(words)
        want[i] = "\n".join(kept)
    assert texts["line_dedup"] == want

    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := lowered(t)) else set() for i, t in want.items()}
    group = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((group[a], group[b]))
                group = {k: x if v == y else v for k, v in group.items()}
    assert set(texts["minmax_dedup"]) == {i for i in group if group[i] == i}
    assert all(texts["minmax_dedup"][i] == want[i] for i in texts["minmax_dedup"])

    uses = [r["doc_id"] for r in results["curriculum_mix"].collect()]
    assert max(map(uses.count, uses)) <= 3 and set(uses) <= set(texts["minmax_dedup"])

    with open(RANKS, "rb") as f:
        ranks = Vocabulary(f.read()).ranks
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = sorted(
        (i, len(ids := reference.encode_ordinary(want[i])), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
         hashlib.sha256(want[i].encode()).hexdigest())
        for i in uses
    )
    assert sorted(map(tuple, results["byte_bpe"].collect())) == coded
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == coded


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_uses_of_repeated_ids_and_equal_rows(spark):
    rows = [(1, f"text {k % 3} of many", "en", "s", 6) for k in range(12)] + [(None, "other words", "en", "s", 5)] * 3
    docs = spark.createDataFrame(rows, SCHEMA)
    used = sorted(map(tuple, corpus_pipeline.in_training_order(spark, docs, SF).collect()), key=repr)
    assert used == sorted(rows, key=repr)  # one source, so each row is used once
    again = corpus_pipeline.in_training_order(spark, docs.repartition(5), SF)
    assert sorted(map(tuple, again.collect()), key=repr) == used


def test_a_repeated_id_does_not_rename_the_others(spark):
    """The order of the mix depends on the rows themselves, not on whether some id is repeated."""
    rows = [(k, f"word {k} and some more", "en", None if k % 2 else "s", 20) for k in range(40)]
    order = lambda rows: [r["doc_id"] for r in corpus_pipeline.in_training_order(spark, spark.createDataFrame(rows, SCHEMA), SF).collect()]
    first = [i for i in order(rows) if i != 7]
    assert [i for i in order([*rows, (7, "", "en", "s", 0)]) if i != 7] == first  # a text without words


def test_one_stays_of_rows_that_repeat_an_id_or_have_none(spark):
    text = "one two three four five six seven eight"
    rows = [(None, text, "en", "s", 1), (None, text, "en", "t", 1), (5, text, "en", "s", 1), (5, text, "en", "s", 1), (9, text, "en", "s", 1)]
    rows += [(None, "quite other words stand in here", "en", "s", 1)] * 2 + [(7, None, "en", "s", 1), (7, "", "en", "s", 1), (None, None, "en", "s", 1)]
    kept = corpus_pipeline.one_of_each(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), SF)
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert [t for i, t in got if t == text] == [text] and (5, text) in got
    assert got.count((None, "quite other words stand in here")) == 1
    assert sum(i == 7 for i, _ in got) == 1 and (None, None) in got and len(got) == 4


def test_rows_that_repeat_an_id_or_have_none(spark):
    rows = [(1, f"one two three {k}", "en", "s", 15) for k in range(4)] + [(None, "other words here", "en", None, 16), (2, None, "en", "s", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch_copy(stage(spark, docs, SF), name)
    assert docs.where("doc_id is null").count() >= 1
