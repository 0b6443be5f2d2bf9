"""Leaderboard upkeep: the same rows as a full build, ranks included, and bands that stay."""

import os
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from catalog_marts.fixtures import silver_table
from catalog_marts.plans.leaderboard import build_leaderboard, credit_sums, open_leaderboard, refresh_leaderboard
from catalog_marts.plans.marts import cast_mart
from catalog_marts.plans.upkeep import changes_between

SF = "/root/testdata/sf0.001"
TABLES = ("titles", "ratings", "principals", "names", "akas")


def content(df):
    rounded = df.withColumn("avg_weighted_rating", F.round("avg_weighted_rating", 8))
    return sorted((tuple(r) for r in rounded.select(sorted(df.columns)).collect()), key=repr)


def full(tables):
    return cast_mart(tables["principals"], tables["ratings"], tables["names"]).fillna("unknown", ["category"])


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
        table = silver_table(spark, SF, name)
        if name == "principals":  # people with few credits, so that scores differ
            table = table.withColumn("name_id", F.concat("name_id", F.lit("/"), F.expr("ordering % 5")))
            table = table.withColumn("category", F.expr("if(ordering % 50 = 0, null, category)"))
        if name == "names":
            table = table.withColumn("name_id", F.explode(F.array(*[F.concat("name_id", F.lit(f"/{i}")) for i in range(4)])))
        table.write.parquet(path)
        stored[name] = spark.read.parquet(path)
    return stored


def refreshed(spark, before, after, path):
    build_leaderboard(before, path)
    assert content(open_leaderboard(spark, path)) == content(full(before))
    old = files_below(f"{path}/board")
    status = refresh_leaderboard(before, after, path, changes_between(before, after))
    assert content(open_leaderboard(spark, path)) == content(full(after))
    rows = {(r.category, r.band): r.action for r in status.collect()}
    for file, time in files_below(f"{path}/board").items():
        role, band = (unquote(x.split("=")[1]) for x in file.split("/")[-3:-1])
        assert (rows[role, int(band)] == "kept") == (old.get(file) == time), file
    return rows


def test_a_moved_mean_needs_no_credits_but_all_ranks(spark, before, tmp_path):
    ratings = before["ratings"].withColumn("average_rating", F.when(F.col("title_id") == "tt2", F.lit(9.9)).otherwise(F.col("average_rating")).cast("float"))
    rows = refreshed(spark, before, {**before, "ratings": ratings.where("title_id <> 'tt5'")}, str(tmp_path / "b"))
    assert "rewritten" in rows.values()


def test_credits_come_and_go(spark, before, tmp_path):
    """The ratings stay, so only bands whose scores or ranks moved are written."""
    credits = before["principals"]
    lowest = full(before).where("category = 'director'").orderBy(F.col("rank").desc(), "name_id").where("avg_weighted_rating is not null").first()
    gone = credits.where(~((F.col("name_id") == lowest.name_id) & (F.col("category") == "director")))
    after = {**before, "principals": gone.unionByName(credits.where("name_id is not null and category = 'writer'").limit(1).withColumn("title_id", F.lit("none")))}
    rows = refreshed(spark, before, after, str(tmp_path / "b"))
    assert list(rows.values()).count("kept") > list(rows.values()).count("rewritten") > 0


def test_people_change_names(spark, before, tmp_path):
    one = before["principals"].where("name_id like '%/1'").first().name_id
    names = before["names"].withColumn("primary_name", F.when(F.col("name_id") == one, "New").otherwise(F.col("primary_name")))
    rows = refreshed(spark, before, {**before, "names": names.unionByName(names.where(F.col("name_id") == one))}, str(tmp_path / "b"))
    assert {"kept", "rewritten"} <= set(rows.values())


def test_there_and_back_and_nothing(spark, before, tmp_path):
    path = str(tmp_path / "b")
    assert set(refreshed(spark, before, before, path).values()) == {"kept"}
    after = {**before, "principals": before["principals"].where("category = 'actor'"), "ratings": before["ratings"].limit(0)}
    changes = changes_between(before, after)
    refresh_leaderboard(before, after, path, changes)
    assert content(open_leaderboard(spark, path)) == content(full(after))
    refresh_leaderboard(after, before, path, changes)
    assert content(open_leaderboard(spark, path)) == content(full(before))


def test_sums_can_be_taken_out_again(spark, before):
    plus = credit_sums(before["principals"], before["ratings"])
    minus = credit_sums(before["principals"], before["ratings"], -1)
    left = plus.unionByName(minus).groupBy("name_id", "category").sum("own", "prior", "credits", "rows")
    assert left.where("`sum(own)` <> 0 or `sum(prior)` <> 0 or `sum(credits)` <> 0 or `sum(rows)` <> 0").isEmpty()
