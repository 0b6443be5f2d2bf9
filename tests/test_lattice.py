"""Aggregate lattice: any grouping equals one over the titles, which no request reads."""

from itertools import combinations

import pytest
from pyspark.sql import functions as F

from catalog_marts.plans.lattice import DERIVED, LEVELS, build_lattice, chosen_level, merge_lattice, rating_statistics

SCHEMA = "title_id string, start_year int, title_type string, average_rating float, num_votes int"
DIMENSIONS = ("start_year", "title_type", "decade")


def titles(n=400):
    kinds = ["movie", "short", None, "é"]
    return [
        (f"t{i}", None if i % 17 == 0 else 1975 + i * 7 % 51, kinds[i % 4], None if i % 5 == 0 else i % 90 / 10, None if i % 11 == 0 else i * 37 % 1000)
        for i in range(n)
    ]


def direct(df, by, condition="true"):
    rows = df.withColumn("decade", F.expr(DERIVED["decade"][1])).where(condition)
    found = rows.groupBy(*by).agg(F.count("*").alias("n"), F.round(F.avg("average_rating"), 9), F.max("num_votes"))
    return sorted(map(tuple, found.where("n > 0").collect()), key=repr)


def asked(spark, path, by, **options):
    found = rating_statistics(spark, path, by, decimals=9, **options)
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.fixture(scope="module")
def lattice(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lattice"))
    df = spark.createDataFrame(titles(), SCHEMA)
    build_lattice(df, path)
    return df, path


@pytest.mark.parametrize("by", [c for k in range(4) for c in combinations(DIMENSIONS, k)])
def test_any_grouping(spark, lattice, by):
    df, path = lattice
    assert asked(spark, path, by) == direct(df, by)


def test_restrictions(spark, lattice):
    df, path = lattice
    assert asked(spark, path, ["title_type"], between={"start_year": (1980, 1991)}) == direct(df, ["title_type"], "start_year between 1980 and 1991")
    assert asked(spark, path, ["decade"], equal={"title_type": "movie"}) == direct(df, ["decade"], "title_type = 'movie'")
    assert asked(spark, path, [], between={"decade": (1990, 2000)}, equal={"title_type": "é"}) == direct(df, [], "decade between 1990 and 2000 and title_type = 'é'")
    assert asked(spark, path, [], equal={"title_type": "none"}) == []


def test_the_smallest_level_answers_and_nothing_else_is_read(spark, lattice):
    _, path = lattice
    level = lambda *d: chosen_level(spark, path, d)
    assert level() == () and level("decade") == ("decade",) and level("title_type") == ("title_type",)
    assert level("start_year") == ("start_year",) and level("start_year", "decade") == ("start_year",)
    assert level("decade", "title_type") == ("decade", "title_type")
    for by, folder in ((["decade"], "decade"), (["start_year", "title_type"], "start_year-title_type"), ([], "all")):
        files = rating_statistics(spark, path, by).inputFiles()
        assert files and all(f"/{folder}/" in f for f in files)
    with pytest.raises(ValueError, match="region"):
        chosen_level(spark, path, ["region"])


def test_levels_are_rolled_up_from_levels(spark, tmp_path, monkeypatch):
    from catalog_marts.plans import lattice as module

    reads = []
    merged = module._merged
    source = str(tmp_path / "facts")
    spark.createDataFrame(titles(), SCHEMA).write.parquet(source)
    monkeypatch.setattr(module, "_merged", lambda rows, d: reads.append((tuple(d), source in rows.inputFiles()[0])) or merged(rows, d))
    build_lattice(spark.read.parquet(source), str(tmp_path / "l"))
    assert [d for d, from_facts in reads if from_facts] == [LEVELS[0]]


def test_merging_more_titles(spark, tmp_path):
    rows, path = titles(), str(tmp_path / "l")
    build_lattice(spark.createDataFrame(rows[:150], SCHEMA), path)
    merge_lattice(path, spark.createDataFrame(rows[150:], SCHEMA))
    df = spark.createDataFrame(rows, SCHEMA)
    for by in ((), ("decade",), ("start_year", "title_type")):
        assert asked(spark, path, by) == direct(df, by)
    merge_lattice(path, df.limit(0))
    assert asked(spark, path, ("title_type",)) == direct(df, ("title_type",))


def test_empty_facts(spark, tmp_path):
    build_lattice(spark.createDataFrame([], SCHEMA), str(tmp_path / "l"))
    assert asked(spark, str(tmp_path / "l"), ("decade",)) == [] and asked(spark, str(tmp_path / "l"), ()) == []
