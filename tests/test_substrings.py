"""Substring index: the rows that a full scan finds, and how few rows it looks at."""

import random

import pytest
from pyspark.sql import functions as F

from catalog_marts.operators.substrings import build_substring_index, candidates, grams, search_substrings

SCHEMA = "id long, title string, chunk int, text string"


def titles(n=3000, seed=1):
    pick = random.Random(seed)
    words = ["the", "ring", "Small", "ÉTÉ", "été", "漢字", "😀x", "İzmir", "ab", "a", "%_", "x'y", "Straße", "\\n", "WORLD"]
    rows = [(i, " ".join(pick.choice(words) for _ in range(pick.randrange(0, 6))), 1, "other") for i in range(n)]
    return rows + [(None, None, 1, "x"), (None, "ring", 1, "x"), (5, "ring", 1, "x"), (5, "ring", 1, "x"), (6, "", 1, "x"), (7, "ri", 1, "")]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    saved = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    df = spark.createDataFrame(titles(), SCHEMA).repartition(5)
    build_substring_index(df, path, "id", "title")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", saved)
    return path


TERMS = ["ring", "RING", "small t", "été", "漢字 ", "😀x", "zmi", "%_ ", "x'y", "straße", "\\n w", "the the the", "nothing like it", "ri", "a", "", "İ", "g"]


def test_same_rows_as_a_scan(spark, index):
    df = spark.createDataFrame(titles(), SCHEMA)
    got = sorted(map(tuple, search_substrings(spark, index, [*TERMS, "ring"]).collect()), key=repr)
    want = []
    for term in TERMS:
        rows = df.where(F.lower("title").contains(term.lower())).select("id", "title").collect()
        want += [(term, r.id, r.title) for r in rows]
    assert got == sorted(want, key=repr)
    assert len({t for t, *_ in got}) == len(TERMS) - 1


def test_few_rows_are_compared(spark, index):
    found = search_substrings(spark, index, ["the the the"]).count()
    looked = candidates(spark, index, ["the the the"]).count()
    assert 0 < found <= looked < 300 < len(titles())
    assert candidates(spark, index, ["qqq ring"]).count() == 0


def test_postings_are_skipped_by_trigram(spark, index):
    codes = grams("ring")
    plan = spark.read.parquet(f"{index}/postings").where(F.col("gram").isin(codes))._jdf.queryExecution().executedPlan().toString()
    assert "In(gram" in plan
    lists = spark.read.parquet(f"{index}/postings")
    assert lists.agg(F.max("n")).first()[0] <= 100  # no list is longer than a chunk


def test_gaps_are_small(spark, index):
    lists = spark.read.parquet(f"{index}/postings").where("n > 30")
    assert lists.where("octet_length(gaps) > n + 1").isEmpty()  # a byte per row


def test_grams():
    assert grams("ab") == [] and grams("aaaa") == [97 << 42 | 97 << 21 | 97]
    assert len(grams("abcd")) == 2 and max(grams("\U0010ffff" * 3)) < 2**63


def test_empty_table(spark, tmp_path):
    build_substring_index(spark.createDataFrame([], SCHEMA), str(tmp_path / "i"), "id", "title")
    assert search_substrings(spark, str(tmp_path / "i"), ["ring", "a"]).count() == 0
    assert search_substrings(spark, str(tmp_path / "i"), []).count() == 0
