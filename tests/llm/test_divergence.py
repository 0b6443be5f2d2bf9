"""Iceberg prefix refinement and source divergence against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest

from catalog_marts.llm import divergence
from catalog_marts.llm.divergence import TERM, frequent_terms, source_divergence

DOCS = "doc_id long, text string, lang string, source string, term string, n int, at int, value int, base int"


def terms_of(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, "x", 0, 0, 0, 0) for i, (t, lang, s) in enumerate(rows)], DOCS)


def expected(rows, min_docs, top):
    rows = [(terms_of(t), lang or "", s or "") for t, lang, s in rows]
    held, counts = defaultdict(Counter), defaultdict(Counter)
    for terms, lang, _ in rows:
        held[lang].update(set(terms))
    kept = {lang: {t for t, n in c.items() if n >= min_docs} for lang, c in held.items()}
    for terms, lang, source in rows:
        counts[lang, source].update(t for t in terms if t in kept[lang])
    result = set()
    for lang in held:
        v, sources = len(kept[lang]), sorted({s for _, la, s in rows if la == lang})
        whole = sum((counts[lang, s] for s in sources), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * v) for t in kept[lang]}
        p, q = {s: share(counts[lang, s]) for s in sources}, share(whole)
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept[lang]), o.encode(), o) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept[lang] if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                result |= {(lang, s, part, item, -value, rank) for rank, (value, _, item) in enumerate(items, 1)}
    return kept, result


def corpus(seed, n=150):
    pick = random.Random(seed)
    stems = ["a", "an", "ant", "anthem", "anthemhood", "é", "éa", "ßé", "漢字", "漢", "abcdefgh", "abcdefghi", "abcdefgx", "z" * 40, "z" * 41]
    word = lambda: pick.choice(stems) + pick.choice(["", "", "s", "b" * pick.randrange(30), chr(97 + int(pick.paretovariate(0.5)) % 26)])
    rows = []
    for _ in range(n):
        text = "".join(pick.choice([str.upper, str, str])(word()) + pick.choice(" 1\n.\x00@[`{\x7f") for _ in range(pick.randrange(0, 40)))
        rows.append((text, pick.choice(["en", "en", "de", None, "漢"]), pick.choice(["s", "s", "s", "t", "é", "", None, "u"])))
    return rows + [("", "xx", "s1"), (None, "xx", None), ("one two", "xx", "s2"), rows[0], rows[0]]


@pytest.mark.parametrize(
    "options",
    [{}, {"first_level": 1, "source_block": 2, "bucket_rows": 7}, {"first_level": 7, "mark_bits": 1, "source_block": 1}],
)
def test_matches_brute_force(spark, options, monkeypatch):
    if options.get("mark_bits"):  # every prefix passes the marks
        monkeypatch.setattr(divergence, "_marks", lambda df, size, bits, f=divergence._marks: (f(df, size, 16)[0] | 1, 16))
    rows = corpus(len(options))
    docs = frame(spark, rows).repartition(4)
    kept, want = expected(rows, 5, 6)
    got = frequent_terms(docs, 5, first_level=options.get("first_level", 3)).collect()
    assert Counter((r.lang, bytes(r.term).decode()) for r in got) == Counter((k, t) for k, ts in kept.items() for t in ts)
    got = [tuple(r) for r in source_divergence(docs, 5, 6, **options).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_long_texts_are_counted_in_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 100)
    rows = [("word other " * 40 + "x" * 350 + f" tail{i % 2}", "en", f"s{i % 3}") for i in range(12)] + corpus(9, 20)
    kept, want = expected(rows, 4, 50)
    assert "x" * 350 in kept["en"]
    got = [tuple(r) for r in source_divergence(frame(spark, rows).repartition(2), 4, 50).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_no_rows_and_no_kept_terms(spark):
    docs = frame(spark, [("one", "en", "a"), ("two", "en", None), (None, None, None)])
    assert source_divergence(docs.limit(0)).count() == 0
    got = {tuple(r) for r in source_divergence(docs).collect()}
    assert got == {("en", "a", "pair", "", 0, 1), ("en", "", "pair", "a", 0, 1)}


def test_levels_prune_before_terms_are_counted(spark):
    """Rare terms without a frequent prefix reach no later level."""
    rows = [(f"common{i % 2} {chr(97 + i % 26)}{chr(97 + i // 26)}qzzzzzz common", "en", "s") for i in range(60)]
    level = divergence.Level(3, 6)
    docs = divergence._prepared(frame(spark, rows), "text", "lang", "source")
    first = divergence._pass(docs, divergence.Level(0, 3), None, 0).groupBy("lang", "prefix").sum("docs")
    alive = first.where("`sum(docs)` >= 30 and octet_length(prefix) = 3").select("lang", "prefix")
    marks, bits = divergence._marks(alive, alive.count(), 24)
    found = {bytes(r.prefix) for r in divergence._pass(docs, level, marks, bits).collect()}
    assert found == {b"common"}
