"""Mart upkeep: the same rows as a full build, and files that nobody had to touch."""

import os
import time
from functools import partial
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from catalog_marts.fixtures import silver_table
from catalog_marts.plans.marts import category_mart
from catalog_marts.plans.together import run_together
from catalog_marts.plans.upkeep import affected_titles, build_mart, changed_keys, changes_between, mean_state, open_mart, refresh_mart

SF = "/root/testdata/sf0.001"
TABLES = ("titles", "ratings", "principals", "names", "akas")


def content(df):
    rounded = df.withColumn("weighted_rating", F.round("weighted_rating", 9))
    return sorted((tuple(r) for r in rounded.select(sorted(df.columns)).collect()), key=repr)


def test_changed_keys_are_found_without_decimals(spark):
    old = spark.createDataFrame([("a", 1.5, None), ("b", 1.0, 2), ("c", None, 3), (None, 1.0, 1)], "k string, x double, y int")
    new = spark.createDataFrame([("a", 1.5, None), ("b", 1.0, None), ("c", None, 3), ("c", None, 3), ("d", 1.0, 1)], "k string, x double, y int")
    changed = changed_keys(old, new, "k")
    assert sorted(r["k"] for r in changed.collect()) == ["b", "c", "d"]
    assert "decimal" not in changed._jdf.queryExecution().executedPlan().toString()


def test_jobs_together_have_their_own_pools(spark):
    seen = {}

    def job(name):
        time.sleep(0.3)
        seen[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")

    run_together(spark, {n: partial(job, n) for n in "abc"}, 3)
    assert seen == {n: n for n in "abc"}


def files_below(folder):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")
    }


@pytest.fixture(scope="module")
def before(spark, tmp_path_factory):
    stored = {}
    for name in TABLES:
        path = str(tmp_path_factory.mktemp("silver") / name)
        silver_table(spark, SF, name).write.parquet(path)
        stored[name] = spark.read.parquet(path)
    return stored


def full(tables):
    mart = category_mart(*[tables[n] for n in TABLES])
    return mart.fillna("unknown", ["title_type"])


def refreshed(spark, before, after, path, **options):
    build_mart(before, path)
    old = files_below(f"{path}/mart")
    status = refresh_mart(before, after, path, **options)
    assert content(open_mart(spark, path)) == content(full(after))
    rows = {(r.title_type, r.genres): (r.action, r.rows) for r in status.collect()}
    now = {tuple(r[:2]): r[2] for r in open_mart(spark, path).groupBy("title_type", "genres").count().collect()}
    assert {k: n for k, (a, n) in rows.items() if a != "removed"} == now
    for file, time in files_below(f"{path}/mart").items():
        part = tuple(unquote(x.split("=")[1]) for x in file.split("/")[-3:-1])
        assert (rows[part][0] == "kept") == (old.get(file) == time), file
    return rows


def test_titles_come_change_and_go(spark, before, tmp_path):
    """No rating changes: partitions without a touched title keep their files."""
    titles = before["titles"]
    new = titles.where("title_id like '%7'").limit(2).withColumns({"title_id": F.concat("title_id", F.lit("n")), "genres": F.lit("Brand,New")})
    renamed = F.when(F.col("title_id") == "tt11", "Another").otherwise(F.col("primary_title"))
    after = {**before, "titles": titles.where("title_id not in ('tt3', 'tt4')").withColumn("primary_title", renamed).unionByName(new)}
    rows = refreshed(spark, before, after, str(tmp_path / "m"))
    actions = [a for a, _ in rows.values()]
    assert actions.count("kept") > 10 and "rewritten" in actions
    assert any(genre == "Brand" for _, genre in rows)


def test_emptied_partitions_go(spark, before, tmp_path):
    lonely = before["titles"].limit(1).withColumns({"title_id": F.lit("q1"), "genres": F.lit("Only 100%/x")})
    old = {**before, "titles": before["titles"].unionByName(lonely)}
    rows = refreshed(spark, old, before, str(tmp_path / "m"))
    assert [k[1] for k, (a, _) in rows.items() if a == "removed"] == ["Only100%/x"] or [k[1] for k, (a, _) in rows.items() if a == "removed"] == ["Only 100%/x"]


def test_people_credits_and_releases(spark, before, tmp_path):
    names = before["names"].withColumn("primary_name", F.when(F.col("name_id") == "nm5", "New Name").otherwise(F.col("primary_name")))
    credits = before["principals"].where("not (title_id = 'tt9' and ordering % 2 = 0)")
    akas = before["akas"].withColumn("region", F.when(F.col("title_id") == "tt12", "NOWHERE").otherwise(F.col("region")))
    refreshed(spark, before, {**before, "names": names, "principals": credits, "akas": akas}, str(tmp_path / "m"))


def test_a_moved_mean_reaches_every_rated_title(spark, before, tmp_path):
    ratings = before["ratings"].withColumn("average_rating", F.when(F.col("title_id") == "tt2", F.lit(9.9)).otherwise(F.col("average_rating")).cast("float"))
    ratings = ratings.where("title_id <> 'tt5'")
    after = {**before, "ratings": ratings}
    rows = refreshed(spark, before, after, str(tmp_path / "m"), changes={"ratings": spark.createDataFrame([("tt2",), ("tt5",)], "title_id string")})
    rated = {tuple(r) for r in full(after).where("weighted_rating is not null").select("title_type", "genres").distinct().collect()}
    assert rated <= {k for k, (a, _) in rows.items() if a == "rewritten"}
    state = spark.read.parquet(str(tmp_path / "m" / "state")).first()
    assert tuple(state) == tuple(mean_state(ratings).first())


def test_refreshing_again_and_nothing_changed(spark, before, tmp_path):
    path = str(tmp_path / "m")
    rows = refreshed(spark, before, before, path)
    assert {a for a, _ in rows.values()} == {"kept"}
    after = {**before, "titles": before["titles"].where("title_id <> 'tt1'")}
    refresh_mart(before, after, path)
    refresh_mart(after, before, path)
    assert content(open_mart(spark, path)) == content(full(before))


def test_no_ratings_left(spark, before, tmp_path):
    refreshed(spark, before, {**before, "ratings": before["ratings"].limit(0)}, str(tmp_path / "m"))


def test_changed_keys(spark):
    of = lambda rows: spark.createDataFrame(rows, "title_id string, x int")
    old, new = of([("a", 1), ("b", 1), ("b", 2), ("c", None), (None, 1), ("d", 1)]), of([("a", 1), ("b", 2), ("c", 0), (None, 2), ("e", 1), ("d", 1), ("d", 1)])
    assert sorted(r[0] for r in changed_keys(old, new, "title_id").collect()) == ["b", "c", "d", "e"]
    people = spark.createDataFrame([("n1",)], "name_id string")
    credits = spark.createDataFrame([("t1", "n1"), ("t1", "n1"), ("t2", "n2"), (None, "n1")], "title_id string, name_id string")
    found = affected_titles({"names": people, "akas": spark.createDataFrame([("t9",), (None,)], "title_id string")}, credits)
    assert sorted(r[0] for r in found.collect()) == ["t1", "t9"]


def test_unchanged_tables_have_no_changes(spark, before):
    assert all(df.isEmpty() for df in changes_between(before, before).values())
