"""Alignment of two tokenizers against a token by token comparison of whole texts."""

import hashlib
import os
import random
import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from catalog_marts.llm import alignment
from catalog_marts.llm.alignment import Pair, align_tokenizers, byte_level_bytes, piece_bytes

FIRST = public_tokenizers.path("byte_bpe_50k.json")
SECOND = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tools():
    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=SECOND)
    a = {i: byte_level_bytes(t) for t, i in first.get_vocab(with_added_tokens=False).items()}
    b = [piece_bytes(second.id_to_piece(i)) for i in range(len(second))]
    return first, second, a, b


def ends(ids, known):
    at, found = 0, []
    for i in ids:
        found.append((at, at + len(known[i]), i))
        at += len(known[i])
    return found


def aligned(text, tools):
    """Tokens of both sides, groups and links of a whole text."""
    first, second, a, b = tools
    if not text:
        return [], [], [], []
    ours, theirs = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    whole = (" " + text).encode()
    if b"".join(a[i] for i in ours) != whole or b"".join(b[i] for i in theirs) != whole:
        return [], [], [], []
    left, right = ends(ours, a), ends(theirs, b)
    cuts = sorted({e for _, e, _ in left} & {e for _, e, _ in right})
    groups, low = [], 0
    for cut in cuts:
        inside = lambda side: ",".join(str(i) for s, e, i in side if low <= s and e <= cut)  # noqa: B023, E731
        groups.append(f"{inside(left)}|{inside(right)}")
        low = cut
    links = [(i, j) for s, e, i in left for t, f, j in right if max(s, t) < min(e, f)]
    return ours, theirs, groups, links


def expected(texts, tools):
    found = [aligned(t, tools) for t in texts]
    docs = Counter(pair for *_, links in found for pair in set(links))
    best = defaultdict(int)
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    rows = []
    for ours, theirs, groups, links in found:
        text = ";".join(groups)
        rows.append((
            len(ours), len(theirs), len(groups), len(links), sum(docs[p] == best[p[0]] for p in links), sum(docs[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if text else "", text,
        ))
    return rows, docs


EDGES = [
    "", None, " ", "  ", "a ", " a", "a  b", "  a  ", "a\nb", "a \n b\n", "x\t y", "it's we'll  'S", "▁", "a▁b c", "<s> </s> <0x41> <|endoftext|>",
    "\x00 \x01\x02", "é \xa0b　 c  d", "漢字 かな 🙂🙂", "ﬁ é", "aaaa aaaaaaa aaa", "12345 1 22,333.4", "a" * 400, "don't... (yes)", "\x1c x",
    "the the the", "of the of", "﻿x ​ y",
]


def corpus(seed, n):
    pick = random.Random(seed)
    pool = ["the ", "of ", "ing", "tion", "an", " ", "  ", "\n", ".", ", ", "é", "ü", "漢", "ca", "t", "S", "12", "'s ", "▁"[: pick.random() < 0.1], "qz"]
    return ["".join(pick.choice(pool) for _ in range(pick.randrange(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("block", [60, 1 << 20])
def test_matches_whole_texts(spark, tools, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK", block)
    monkeypatch.setattr(alignment, "PART_PAIRS", 50)
    texts = EDGES + corpus(block, 120) + EDGES[:12] + corpus(block, 20)
    keys = [None if i % 9 == 0 else i // 2 for i in range(len(texts))]
    rows = [(k, t, "x", 1, 1, "c") for k, t in zip(keys, texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keys string, block int, pairs int, codes string").repartition(3)
    result, pairs = align_tokenizers(docs, FIRST, SECOND)
    want, counts = expected(texts, tools)
    got = Counter(tuple(r) for r in result.collect())
    assert got == Counter((k, *row) for k, row in zip(keys, want))
    assert {(r.a, r.b): r.docs for r in pairs.collect()} == counts
    assert sum(row[3] for row in want) > 1000 and any(row[0] == 0 for row in want)


def test_empty_table_and_no_groups(spark, tools):
    docs = spark.createDataFrame([(1, "a cat"), (1, "a cat")], "doc_id int, text string")
    result, pairs = align_tokenizers(docs.limit(0), FIRST, SECOND)
    assert result.count() == 0 and pairs.count() == 0
    result, _ = align_tokenizers(docs, FIRST, SECOND, keep_groups=False)
    want, _ = expected(["a cat"] * 2, tools)
    assert [tuple(r) for r in result.collect()] == [(1, *row[:-1], None) for row in want]


def test_identity_map(tools):
    first, second, a, b = tools
    with open(FIRST, encoding="utf-8") as f, open(SECOND, "rb") as g:
        pair = Pair(f.read(), g.read())
    for i, j in enumerate(pair.same.tolist()):
        if j >= 0:
            assert b[j] == a.get(i, b"<|endoftext|>")
    assert len({a[i] for i in a} & set(b)) == (pair.same >= 0).sum() > 5000


def test_only_irregular_groups_reach_the_pair_shuffle(spark):
    text = " ".join(["the", "of", "and"] * 20)
    docs = spark.createDataFrame([(i, text) for i in range(5)], "doc_id long, text string")
    with open(FIRST, encoding="utf-8") as f, open(SECOND, "rb") as g:
        shared = spark.sparkContext.broadcast((f.read(), g.read()))
    blocks = alignment._blocks(docs, shared, "doc_id", "text", False)
    assert blocks.where("block is not null").agg({"pairs": "sum"}).first()[0] == 0


def test_a_task_encodes_without_threads_of_its_own():
    """In a process of its own, as other tests may have started the encoder's threads."""
    code = f"""
import os
import pyarrow as pa
from catalog_marts.llm.alignment import Pair, _Counter
counter = _Counter(Pair(open({FIRST!r}).read(), open({SECOND!r}, "rb").read()))
before = len(os.listdir("/proc/self/task"))
state = counter.block(pa.array([f"word{{k}} of many" for k in range(5000)]), False)
print(len(state["digests"]), len(os.listdir("/proc/self/task")) - before)
"""
    root = Path(__file__).resolve().parents[2]
    env = {**os.environ, "PYTHONPATH": str(root)}
    env.pop("TOKENIZERS_PARALLELISM", None)
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["5000", "0"], done.stderr
