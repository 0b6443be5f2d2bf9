"""Duplicates, repeats and mixing of texts against brute force on small random corpora."""

import random
import re
import time
from collections import Counter, namedtuple

import numpy as np
import pyarrow as pa
import pytest

from catalog_marts.llm import curriculum, lines, minmax, sketch
from catalog_marts.llm.components import connected_components
from catalog_marts.llm.curriculum import mix_sources, training_order
from catalog_marts.llm.lines import Tuning, deduplicate_lines
from catalog_marts.llm.minmax import near_duplicates
from catalog_marts.llm.phrases import remove_repeats
from catalog_marts.llm.text import WORD

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id int, hash int, component int, size int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, 0, 0, 0, 0) for i, t, s in rows], DOCS)


def lowered(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def corpus(seed, n=120, words=400):
    pick = random.Random(seed)
    word = lambda: pick.choice("abcdefg") + str(int(pick.paretovariate(0.7)) % words)
    rows, texts = [], []
    for i in range(n):
        kind = pick.random()
        if texts and kind < 0.2:
            text = pick.choice(texts)
        elif texts and kind < 0.5:
            parts = pick.choice(texts).split(" ")
            for _ in range(pick.randrange(1, 4)):
                if parts:
                    parts[pick.randrange(len(parts))] = word()
            text = " ".join(parts)
        else:
            text = "\n".join(" ".join(word() for _ in range(pick.randrange(0, 30))) for _ in range(pick.randrange(1, 5)))
        texts.append(text)
        rows.append((1000 - i, text, pick.choice(["s1", "s2", "é", None])))
    return rows


EDGES = [(2000, None, "s1"), (2001, "", "s1"), (2002, " \t\n\r ", None), (2003, "One", "s1"), (2004, "one", "s2"), (2005, "x" * 100_000, "s1")]


def reachable(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("words, seed", [(2, 1), (5, 2)])
def test_near_duplicates(spark, monkeypatch, words, seed):
    monkeypatch.setattr(minmax, "CHUNK", 6)
    rows = corpus(seed) + EDGES + [(None, "a lone text without a key", "s1"), (2003, "One", "s1")]
    sets = {}
    for i, text, _ in rows:
        w = lowered(text)
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    ids = [i for i in sets if i is not None]
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = reachable(ids, links)
    got = near_duplicates(frame(spark, rows), words=words).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["n_shingles"] == len(sets[r["doc_id"]])
        assert r["component_id"] == want.get(r["doc_id"])
        assert r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"])


def test_unlinked_texts_of_a_band_are_split(spark, monkeypatch):
    """Texts of one template that are no links, in blocks of two chunks."""
    monkeypatch.setattr(minmax, "CHUNK", 8)
    largest, plain = [], minmax.clustered

    def watched(df, keys, *rest):
        largest.append(df.groupBy(*keys).count().agg({"count": "max"}).first()[0] or 0)
        return plain(df, keys, *rest)

    monkeypatch.setattr(minmax, "clustered", watched)
    pick = random.Random(6)
    shared = [f"w{k}" for k in range(80)]
    rows = [(i, " ".join(shared + [f"x{i}y{k}" for k in range(16 + i % 40 // 2)]), "s") for i in range(200)]
    for i in range(200, 240):  # links of some
        parts = rows[pick.randrange(200)][1].split(" ")
        rows.append((i, " ".join(parts[:-4] + [f"z{i}"]), "s"))
    sets = {i: set(text.split(" ")) for i, text, _ in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    got = near_duplicates(frame(spark, rows), words=1).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == reachable(sets, links)
    assert 0 < max(largest) <= 4 * 8


def test_repeated_key_with_other_texts(spark):
    rows = [(5, "a b c d", "s"), (5, "e f g h", "s"), (3, "e f g h", "s"), (9, "a b c d", "s")]
    got = near_duplicates(frame(spark, rows), words=2).collect()
    assert {r["component_id"] for r in got} == {3}


@pytest.mark.parametrize("seed, early", [(3, False), (4, True)])
def test_lines(spark, seed, early):
    # early: searches end at the first candidate, and words are met in chunks
    tuning = Tuning(chunk=20, wide=12, likely=2.0, long=0, tries=1) if early else Tuning(wide=12)
    rows = corpus(seed) + EDGES + [(None, rows_text := "b1 b2 b3 b4", "s1"), (3000, rows_text, "s1"), (3001, rows_text, "s1")]
    earlier, want = [], {}
    for i, text, _ in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        kept = []
        for line in text.split("\n"):
            words = set(lowered(line))
            if not words or not any(100 * len(words & e) >= 80 * len(words | e) for e in earlier):
                kept.append(line)
            if words:
                earlier.append(words)
        want[i] = ("\n".join(kept), text.count("\n") + 1, text.count("\n") + 1 - len(kept))
    want[None], want[2000] = (rows_text, 1, 0), (None, 0, 0)
    got = deduplicate_lines(frame(spark, rows), tuning=tuning).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["text"], r["n_lines"], r["n_removed"]) == want[r["doc_id"]]


def test_asking_lines_meet_in_blocks_of_two_chunks():
    """Lines with one word in common that all ask: every pair once, in blocks of bounded size."""
    n, sets = 400, [[1 << 32, (k + 2) << 32] for k in range(400)]
    batch = pa.RecordBatch.from_arrays([
        pa.array(np.arange(n)), pa.array(np.zeros(n, np.int32)), pa.array(np.arange(n) * 7919), pa.array(sets), pa.array([True] * n),
    ], ["doc", "line", "hash", "words", "asks"])
    value = namedtuple("Shared", "value")
    table = value(np.zeros(1 << lines.BITS, np.uint8))
    asked = value(np.zeros(1 << lines.MARK_BITS, np.uint8))
    asked.value[lines.places(np.array([1 << 32], np.uint64), lines.MARK_BITS)] = 1
    table.value[:] = next(k for k in range(256) if sketch.decoded(np.array([k], np.uint8))[0] >= n)
    met, largest = Counter(), 0
    count = float(sketch.decoded(table.value[:1])[0])
    [out] = lines._meetings([batch], table, 40, 16, Tuning(chunk=count / 8), asked)
    for data in out.column("lines").to_pylist():
        rows = int(np.frombuffer(data, np.int64, 1)[0])
        head = np.frombuffer(data, np.int64, rows * (len(data) // 8 - 1 - 2 * rows) // rows, 8).reshape(-1, rows)
        head = head[:, head[0] == 1 << 32]
        for block in set(head[1].tolist()):
            group = head[:, head[1] == block]
            largest = max(largest, group.shape[1])
            for a in range(group.shape[1]):
                for b in range(a):
                    if len(head) < 8 or group[7, a] != group[7, b] or group[7, a] == 2:
                        met[tuple(sorted((group[2, a], group[2, b])))] += 1
    assert len(met) == n * (n - 1) // 2
    assert set(met.values()) == {1}
    assert largest <= 2 * 2 * n / 8


def test_lines_of_a_repeated_key(spark):
    rows = [(1, "a b c\nd e f", "s"), (2, "a b c\nx y z", "s"), (2, "p q r\ns t u", "s")]
    got = sorted(r["text"] for r in deduplicate_lines(frame(spark, rows)).collect())
    assert got == ["a b c\nd e f", "p q r\ns t u", "x y z"]


def test_a_text_of_many_repeated_lines(spark):
    """Lines of one text, half of them repeated: time grows with its length, not with its square."""
    n = 400_000
    text = "\n".join(x for k in range(n // 2) for x in (f"w{k} v{k}", "once more"))
    started = time.monotonic()
    [got] = deduplicate_lines(frame(spark, [(1, text, "s")])).collect()
    assert (got["n_lines"], got["n_removed"]) == (n, n // 2 - 1)
    assert got["text"] == "\n".join(["w0 v0", "once more", *(f"w{k} v{k}" for k in range(1, n // 2))])
    assert time.monotonic() - started < 60


@pytest.mark.parametrize("hot", [1000, 0])
def test_repeats(spark, hot):
    window = 8
    rows = corpus(5) + EDGES + [(None, "k1 k2 k3 k4 k5 k6 k7 k8 k9", "s"), (3000, "z k1 k2 k3 k4 k5 k6 k7 k8 y", "s"), (3001, "w " * 30, "s")]
    words = [re.findall(WORD, t or "") for _, t, _ in rows]
    seen = Counter(tuple(w[s : s + window]) for w in words for s in range(len(w) - window + 1))
    want = []
    for (i, _, _), w in zip(rows, words):
        gone = {s + k for s in range(len(w) - window + 1) if seen[tuple(w[s : s + window])] > 1 for k in range(window)}
        want.append((str(i), len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    got = remove_repeats(frame(spark, rows), window=window, phrase=3, hot=hot).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in got) == sorted(want)


@pytest.mark.parametrize("whole", [False, True])
def test_mix(spark, whole):
    rows = corpus(6, 200) + EDGES + [(None, "a b c", "s1")]
    got = mix_sources(frame(spark, rows), whole=whole, buckets=16).collect()
    assert len(got) == len(rows)
    sources = {}
    for r in got:
        s = sources.setdefault(r["source"], {"size": 0, "taken": 0, "most": 0, "target": r["target"]})
        s["size"] += r["size"]
        s["taken"] += r["taken"]
        s["most"] = max(s["most"], r["size"])
        assert r["taken"] <= 3 * r["size"] and len(r["positions"]) <= 3
        assert all(0 <= p <= 1 for p in r["positions"])
    assert abs(sum(s["target"] for s in sources.values()) - sum(s["size"] for s in sources.values())) < 1e-6
    order = sorted((s for s in sources if s is not None)) + [None]
    for k, name in enumerate(order):
        s = sources[name]
        assert s["target"] <= 3 * s["size"] + 1e-9
        assert abs(s["taken"] - s["target"]) <= (s["most"] / 2 + 1 if whole else 1)
    open_ = [sources[n]["target"] / (k % 3 + 1) for k, n in enumerate(order) if sources[n]["target"] < 3 * sources[n]["size"] - 1e-9]
    assert max(open_) - min(open_) < 1e-6  # those that don't stop share by weight
    again = mix_sources(frame(spark, rows[::-1]), whole=whole, buckets=64).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_order_follows_the_schedule(spark):
    rows = [(i, "w " * 10, "abc"[i % 3]) for i in range(600)]
    mixed = mix_sources(frame(spark, rows), weights=(1,))
    order = [r["position"] for r in training_order(mixed).collect()]
    assert order == sorted(order) and len(order) == 600
    first = {r["source"]: r["positions"] for r in mixed.collect()}
    places = {s: sorted(p for r in mixed.collect() if r["source"] == s for p in r["positions"]) for s in first}
    half = {s: sum(p < 0.5 for p in v) / len(v) for s, v in places.items()}
    assert half["a"] > 0.6 and half["b"] < 0.4 and 0.45 < half["c"] < 0.55
    assert curriculum.SCHEDULES[0][0][1] > 1


def test_empty_tables(spark):
    none = frame(spark, [])
    assert near_duplicates(none).count() == deduplicate_lines(none).count() == 0
    assert remove_repeats(none).count() == mix_sources(none).count() == 0


def test_components(spark):
    pick = random.Random(9)
    links = [(pick.randrange(300), pick.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 560)]
    want = reachable(range(600), links)
    got = connected_components(spark.createDataFrame([*links, (None, 3), (7, None)], "a long, b long"))
    assert {r["id"]: r["component"] for r in got.collect()} == {i: c for i, c in want.items() if i != c}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_tables_never_count_too_low():
    tally = sketch.Tally(16)
    import numpy as np

    place = np.array([1, 1, 5, 65535])
    tally.add(place)
    tally.add(np.array([5]), np.array([1000]))
    assert sketch.decoded(sketch.coded(tally.counts))[[0, 1, 5, 65535]].tolist()[:2] == [0, 2]
    assert sketch.decoded(sketch.coded(tally.counts))[5] >= 1001


@pytest.mark.parametrize("count", [1, 3, 4, 8, 30, 33, 36])
def test_tables_with_few_words(spark, count):
    """Fewer words in a whole batch than a shingle or a window has."""
    docs = frame(spark, [(1, " ".join(f"w{k}" for k in range(count)), "s")]).coalesce(1)
    assert [(r["n_shingles"], r["kept"]) for r in near_duplicates(docs).collect()] == [(max(1, count - 4), True)]
    assert [(r["n_words"], r["n_removed"]) for r in remove_repeats(docs).collect()] == [(count, 0)]
    assert [r["n_removed"] for r in deduplicate_lines(docs).collect()] == [0]


def test_line_dedup_keeps_columns_of_any_name(spark):
    names = ["_key", "_doc", "_gone", "_lines", "_rows", "_shared", "_text", "_row", "a.b", "n_lines"]
    rows = [(1, "one two\nthree", *range(10)), (2, "one two\nfour", *range(10, 20)), (2, "five", *range(20, 30)), (None, None, *range(30, 40))]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names])
    got = {r["_key"]: r.asDict() for r in deduplicate_lines(docs).collect()}
    assert {k: r["text"] for k, r in got.items()} == {0: "one two\nthree", 10: "four", 20: "five", 30: None}
    assert all(r[n] == k + i for k, r in got.items() for i, n in enumerate(names[:-1]))
    assert {k: (r["n_lines"], r["n_removed"]) for k, r in got.items()} == {0: (2, 0), 10: (2, 1), 20: (1, 0), 30: (0, 0)}
