"""Archives by round trip, also in many splits; the classifier by held-out accuracy."""

import base64
import hashlib
import random

import numpy as np
import pytest

from catalog_marts.llm.toxicity import score_toxicity, toxicity, train
from catalog_marts.llm.warc import read_warc, write_warc
from catalog_marts.sources import scratch_dir

PAGES = [
    (1, "u1", "hello"), (2, "u2\r\nWARC-Type: x", "hello"), (3, None, None), (4, "u", ""),
    (5, "u5", "a WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\nxx"),
    (6, "u", "é" * 3000 + "WARC/1.1\r\n"), (None, "n", "hello"), (8, "z", "WARC/1.1\r\nContent-Length: 9999999\r\n\r\n"),
    (9, "r", "same"), (9, "r", "same"),
] + [(100 + i, "u", f"page {i} " * 50) for i in range(60)]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, 0, "x") for r in rows], "page_id long, url string, html string, size int, _sha1 string")


@pytest.mark.parametrize("split", ["128m", "3000b"])
def test_round_trip(spark, conf, split):
    path = scratch_dir(spark, "warc")
    write_warc(pages(spark).coalesce(2), path)
    conf(spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="1")
    want = sorted((str(k), len((h or "").encode()), digest(h)) for k, _, h in PAGES)
    for payload in (False, True):
        got = read_warc(spark, path, payload=payload).collect()
        assert sorted((str(r["record_id"]), r["payload_bytes"], r["payload_digest"]) for r in got) == want
        assert all(r["intact"] for r in got)
        kinds = {(r["record_id"], r["record_type"], r["refers_to"]) for r in got if int(r["record_id"] or 1) < 9}
        assert {("1", "revisit", "2"), ("2", "response", None), ("3", "revisit", "4"), (None, "revisit", "2")} <= kinds
        assert [r["record_type"] for r in got if r["record_id"] == "9"] == ["response"] * 2
    texts = {r["record_id"]: bytes(r["payload"]).decode() for r in got if r["record_type"] == "response"}
    assert all(texts[str(k)] == (h or "") for k, _, h in PAGES if str(k) in texts)


def test_small_payloads_and_empty_table(spark):
    path = scratch_dir(spark, "warc")
    write_warc(pages(spark), path, min_bytes=5)
    got = {r["record_id"]: r["record_type"] for r in read_warc(spark, path).collect()}
    assert got["1"] == "revisit" and got["3"] == got["4"] == "response"
    path = scratch_dir(spark, "warc")
    write_warc(pages(spark).limit(0), path)
    assert read_warc(spark, path).count() == 0


def warc_file(folder, name, data):
    (folder / name).write_bytes(data)
    return str(folder / name)


def test_both_versions_and_other_files(spark, tmp_path):
    body = b"WARC/1.0\r\nx WARC/1.7 WARC/1."
    record = lambda v, i: b"WARC/1.%d\r\nWARC-Type: resource\r\nWARC-Record-ID: <%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (v, i, len(body), body)
    path = warc_file(tmp_path, "a.warc", record(0, 1) + record(1, 2) + record(0, 3))
    got = read_warc(spark, path, payload=True).collect()
    assert sorted((r["record_id"], bytes(r["payload"])) for r in got) == [(str(i), body) for i in (1, 2, 3)]
    for data in (b"junk" + record(0, 1), b"WARC/1.2\r\n" + record(0, 1)[10:], b"\x1f\x8b zipped"):
        with pytest.raises(Exception, match="does not begin as a WARC"):
            read_warc(spark, warc_file(tmp_path, "b.warc", data)).collect()
    assert read_warc(spark, warc_file(tmp_path, "c.warc", b"")).count() == 0


def texts(spark, n=400, seed=1):
    pick = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = [f"w{pick.randrange(300)}" for _ in range(pick.randrange(5, 60))]
        if toxic:
            for _ in range(3):
                words.insert(pick.randrange(len(words)), pick.choice(["Vile,", "nasty", "rotten."]))
        rows.append((i, " ".join(words), 0.5, True))
        if pick.random() < 0.6:
            labels.append((i, int(toxic)))
    rows += [(9000, None, 0.1, True), (9001, "", 0.1, True), (None, "vile nasty rotten", 0.1, True), (0, rows[0][1], 0.2, False), (9002, "ok " * 50_000, 0.0, True)]
    labels += [(None, 1), (3, None), (0, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, score double, held_out boolean"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = texts(spark)
    got = toxicity(docs, labels).collect()
    assert len(got) == docs.count()
    held = [r for r in got if r["held_out"] and r["doc_id"] < 400]
    assert 40 < len(held) < 130
    assert np.mean([r["predicted"] == (r["doc_id"] % 5 == 0) for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[None]["predicted"] == 1 and by_id[None]["held_out"] is False
    assert by_id[9000]["score"] == by_id[9001]["score"]
    again = toxicity(docs, labels).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_without_labels(spark):
    docs, labels = texts(spark, 40)
    assert {r["score"] for r in toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity(docs.limit(0), labels).count() == 0
    assert score_toxicity(docs, train([], [], 0.1)).columns == docs.columns


def test_hidden_positives_are_discounted():
    """Half of the toxic texts are in the unlabelled sample; the prior keeps them positive."""
    random = np.random.default_rng(0)
    toxic = [np.append(random.integers(0, 1000, 20), [5000, 5001]) for _ in range(200)]
    clean = [random.integers(0, 1000, 22) for _ in range(800)]
    unique = lambda xs: [np.unique(x) for x in xs]
    model = train(unique(toxic[:100]), unique(toxic[100:] + clean), 0.2)
    score = lambda x: model.weights[x].sum() + model.bias
    assert np.mean([score(x) > 0 for x in unique(toxic[100:])]) > 0.95
    assert np.mean([score(x) > 0 for x in unique(clean)]) < 0.02


def test_a_key_with_many_rows_counts_once(spark, monkeypatch):
    """What the driver collects is bounded in texts and in features, whatever the rows of a key."""
    from catalog_marts.llm import toxicity

    seen = {}
    monkeypatch.setattr(toxicity, "train", lambda positive, unlabelled, prior: seen.update(p=positive, u=unlabelled) or toxicity.ToxicModel(np.zeros(1 << toxicity.BITS), 0.0, prior))
    docs = spark.createDataFrame([(1, f"bad word{i}") for i in range(300)] + [(k, f"fine text {k} and more") for k in range(2, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    toxicity.fit_toxicity(docs, labels, folds=1000, max_unlabelled=5, max_features=3)
    assert len(seen["p"]) <= 1 and len(seen["u"]) == 5 and max(map(len, seen["u"])) <= 3
