"""Word hashing against a pattern; byte-level BPE against a public library and by round trips."""

import base64
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from catalog_marts.llm.bpe import Encoder, PrefixTable, Vocabulary, bpe_decode, bpe_encode
from catalog_marts.llm.text import WORD, hash_words, utf8

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    with open(RANKS, "rb") as f:
        return Vocabulary(f.read())


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


@pytest.mark.parametrize("block", [7, 64, 1 << 20])
def test_words_are_the_pattern(block):
    pick = random.Random(3)
    texts = ["".join(pick.choice("abAZz \n\t\x0b\x0c\r\x1c\xa0é漢x") for _ in range(pick.randrange(80))) for _ in range(200)]
    texts += ["", None, " ", "x" * 500, *("a" * k for k in (7, 8, 9, 16, 17))]
    data, offsets = utf8(pa.array(texts))
    words = hash_words(data, offsets, lower=True, block=block)
    seen = {}
    for i, text in enumerate(texts):
        lowered = re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode())
        want = re.findall(WORD.encode(), lowered)
        got = words.hashes[words.bounds[i] : words.bounds[i + 1]].tolist()
        assert len(want) == len(got)
        for word, value in zip(want, got):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_pieces_and_edits_match(vocabulary, reference):
    pick = random.Random(1)
    encode = lambda b: reference._core_bpe.encode_single_piece(b) if b else []
    for _ in range(400):
        data = bytes(pick.choice(b"aabcthe inr\x00\xff\xc3\xa9  ") for _ in range(pick.randrange(1, 80)))
        table = PrefixTable(vocabulary, data[:20])
        table.append(data[20:])
        assert table.tokens() == encode(data)
        assert table.tokens(len(data) // 2) == encode(data[: len(data) // 2])
        start = pick.randrange(len(data) + 1)
        end, new = min(len(data), start + pick.randrange(5)), bytes(pick.choice(b"aethr ") for _ in range(pick.randrange(5)))
        table.replace(start, end, new)
        assert table.tokens() == encode(data[:start] + new + data[end:])


def test_edit_of_a_long_piece_stops_early(vocabulary, reference):
    data = b"the quick brown fox " * 500
    table = PrefixTable(vocabulary, data)
    assert table.replace(5000, 5003, b"x") < 1000
    assert table.tokens() == reference._core_bpe.encode_single_piece(data[:5000] + b"x" + data[5003:])


def test_texts_match(vocabulary, reference):
    pick = random.Random(2)
    encoder = Encoder(vocabulary, public_tokenizers.PATTERN)
    texts = ["".join(pick.choice("aeiou thrsnd  \n\n'sll1280éß漢🙂ABC-_.,;!") for _ in range(pick.randrange(60))) for _ in range(500)]
    texts += ["", "<|endoftext|>", "a" * 3000, " " * 2000 + "x", "ab " * 400_000]
    for text in texts:
        ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert ids == reference.encode_ordinary(text)
        assert encoder.decode(encoder.encode(text)) == text.encode()


def test_rank_file_must_hold_all_bytes():
    with pytest.raises(ValueError):
        Vocabulary(base64.b64encode(b"a") + b" 0\n")


def test_rows_nulls_and_extra_columns(spark, reference):
    rows = [(1, "Hello wörld", 0), (None, "x", 1), (2, None, 2), (3, "", 3), (1, "Hello wörld", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    coded = bpe_encode(docs, RANKS, public_tokenizers.PATTERN)
    got = sorted((r["doc_id"] or 0, np.frombuffer(r["ids"], "<u4").tolist()) for r in coded.collect())
    assert got == sorted((k or 0, reference.encode_ordinary(t or "")) for k, t, _ in rows)
    both = bpe_encode(docs, RANKS, public_tokenizers.PATTERN, decoded=True).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["decoded"]).decode()) for r in both) == sorted((k or 0, t or "") for k, t, _ in rows)
    back = sorted((r["doc_id"] or 0, bytes(r["decoded"]).decode()) for r in bpe_decode(coded, RANKS, public_tokenizers.PATTERN).collect())
    assert back == sorted((k or 0, t or "") for k, t, _ in rows)
    assert bpe_encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
