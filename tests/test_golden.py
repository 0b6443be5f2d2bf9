"""Hand-checked results on the mini catalogue."""

import pytest

from catalog_marts.operators import crew_rollup, explode_category, region_rollup, weighted_rating
from catalog_marts.plans import cast_mart, category_mart, report_q1, report_q2, report_q3, report_q4


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_weighted_rating(mini):
    got = rows(weighted_rating(mini.ratings), "title_id", "weighted_rating")
    assert got == [("tt1", 7.5), ("tt2", 6.25)]


def test_weighted_rating_nulls(spark):
    ratings = spark.createDataFrame(
        [("a", 8.0, None), ("b", None, 10), ("c", 6.0, 0)],
        "title_id string, average_rating float, num_votes int",
    )
    got = rows(weighted_rating(ratings), "title_id", "weighted_rating")
    assert got == [("a", None), ("b", None), ("c", 7.0)]
    no_prior = weighted_rating(ratings, prior_votes=0)
    assert ("c", None) in rows(no_prior, "title_id", "weighted_rating")


def test_category_mart(mini):
    mart = category_mart(mini.titles, mini.ratings, mini.principals, mini.names, mini.akas)
    got = rows(mart, "title_id", "title_type", "genres", "average_rating", "num_votes",
               "weighted_rating", "actors", "directors", "producers", "regions", "region_count")
    assert got == sorted([
        ("tt1", "movie", "Comedy", 8.0, 1000, 7.5, "Ann", "Bob", "", "FR,US,US", 2),
        ("tt1", "movie", "Drama", 8.0, 1000, 7.5, "Ann", "Bob", "", "FR,US,US", 2),
        ("tt2", "movie", "unknown", 6.0, 3000, 6.25, "Ann", "", "Ann", None, None),
        ("tt3", "short", "Drama", None, None, None, "Cy", "Bob", "", None, None),
        ("tt4", "short", "Sci-Fi", None, None, None, None, None, None, None, None),
    ], key=repr)


def test_cast_mart(mini):
    cast = cast_mart(mini.principals, mini.ratings, mini.names)
    assert rows(cast, "name_id", "primary_name", "category", "avg_weighted_rating",
                "total_movies", "rank") == sorted([
        ("nm1", "Ann", "actor", 6.875, 2, 1),
        ("nm3", "Cy", "actor", None, 0, 2),
        ("nm9", None, "actress", 7.5, 1, 1),
        ("nm2", "Bob", "director", 7.5, 1, 1),
        ("nm1", "Ann", "producer", 6.25, 1, 1),
    ], key=repr)


def test_cast_mart_options(mini):
    cast = cast_mart(mini.principals, mini.ratings, mini.names, min_titles=2, top_n=1)
    assert rows(cast, "name_id", "category", "rank") == [("nm1", "actor", 1)]


def test_cast_mart_counts_name_copies_like_a_join(spark, mini):
    """Ann is listed twice and once more under another name: each credit counts per listing."""
    names = mini.names.unionAll(mini.names.where("name_id = 'nm1'")).unionAll(
        spark.createDataFrame([("nm1", "Anna", None, None)], mini.names.schema)
    )
    cast = cast_mart(mini.principals, mini.ratings, names)
    assert rows(cast, "name_id", "primary_name", "category", "total_movies") == sorted([
        ("nm1", "Ann", "actor", 4),
        ("nm1", "Anna", "actor", 2),
        ("nm1", "Ann", "producer", 2),
        ("nm1", "Anna", "producer", 1),
        ("nm2", "Bob", "director", 1),
        ("nm3", "Cy", "actor", 0),
        ("nm9", None, "actress", 1),
    ], key=repr)


def test_crew_order_across_spans(spark):
    """Names come in billing order, also when a cast is longer than one first-level list."""
    order = [25000, 3, 10000, 9999, 1, 50000, 12, 20001, 0, None]
    principals = spark.createDataFrame(
        [("t", o, f"n{o}", "actor") for o in order] + [("u", 1, "n1", "writer"),
                                                       ("v", 1, "n1", None)],
        "title_id string, ordering int, name_id string, category string",
    )
    names = spark.createDataFrame([(f"n{o}", f"P{o}") for o in order],
                                  "name_id string, primary_name string")
    got = {r.title_id: tuple(r)[1:] for r in crew_rollup(principals, names).collect()}
    ordered = sorted(order, key=lambda o: (o is not None, o))
    assert got == {"t": (",".join(f"P{o}" for o in ordered), "", ""),
                   "u": ("", "", ""), "v": ("", "", "")}


def test_crew_empty_names_are_kept(spark):
    principals = spark.createDataFrame(
        [("t", 1, "a", "actor"), ("t", 15000, "b", "actor"), ("t", 2, "c", "editor")],
        "title_id string, ordering int, name_id string, category string",
    )
    names = spark.createDataFrame([("a", ""), ("b", "B"), ("c", "C")],
                                  "name_id string, primary_name string")
    assert crew_rollup(principals, names).first().actors == ",B"
    custom = crew_rollup(principals, names, {"all": ["actor", "editor"], "cut": ["editor"]})
    assert custom.first().asDict() == {"title_id": "t", "all": ",C,B", "cut": "C"}


def test_region_rollup(spark, mini):
    assert rows(region_rollup(mini.akas), "title_id", "regions", "region_count") == [
        ("tt1", "FR,US,US", 2)]
    assert region_rollup(mini.akas, distinct=True).first().regions == "FR,US"
    odd = spark.createDataFrame([("t", "Unknown"), ("t", "")], "title_id string, region string")
    assert rows(region_rollup(odd), "regions", "region_count") == [("", 1)]


def test_explode_category(spark):
    df = spark.createDataFrame(
        [(1, "A,,B"), (2, ""), (3, None), (4, " C , ")], "id int, genres string")
    assert rows(explode_category(df), "id", "genres") == [
        (1, "A"), (1, "B"), (1, "unknown"), (2, "unknown"), (3, "unknown"), (4, "C"),
        (4, "unknown")]
    piped = spark.createDataFrame([(1, "A|B,C")], "id int, tags string")
    assert rows(explode_category(piped, "tags", "|", "none"), "tags") == [("A",), ("B,C",)]


def test_reports(mini):
    mart = category_mart(mini.titles, mini.ratings, mini.principals, mini.names, mini.akas)
    assert rows(report_q3(mart, ["ALPHA"]), "title_type", "match_count", "avg_rating") == [
        ("movie", 2, 7.33)]
    assert rows(report_q3(mart, ["alpha"], grain="title"), "avg_rating") == [(7.0,)]
    assert report_q3(mart, ["alpha"], decimals=None).first().avg_rating == pytest.approx(22 / 3)
    with pytest.raises(ValueError):
        report_q3(mart, grain="other")

    assert [tuple(r) for r in report_q1(mini.titles, mini.ratings).collect()] == [
        (2000, "movie", 2, 7.0, 3000)]
    assert report_q1(mini.titles, mini.ratings, last_year=1999).count() == 0

    top = report_q2(mart, min_rating=6.0, min_votes=1)
    assert [r.title_id for r in top.collect()] == ["tt1", "tt2"]
    assert report_q2(mart, min_rating=6.0, min_votes=1, k=1).count() == 1

    best = report_q4(mart, min_votes=0)
    assert best.columns == ["primary_title", "start_year", "average_rating", "num_votes",
                            "rank_in_year"]
    assert [(r.primary_title, r.rank_in_year) for r in best.collect()] == [
        ("Alpha", 1), ("Alpha 2", 2)]
    assert report_q4(mart, min_votes=0, n=1, keep_id=True).first().title_id == "tt1"
    assert report_q4(mart, min_votes=0, max_rows=1).count() == 1


def test_rating_bound_is_a_float(spark, mini):
    """A stored 4.7 satisfies a bound of 4.7, although 4.7 as a float is below 4.7 as a double."""
    ratings = spark.createDataFrame([("tt1", 4.7, 10)], mini.ratings.schema)
    mart = explode_category(mini.titles.join(ratings, "title_id"))
    assert report_q2(mart, min_rating=4.7, min_votes=1).count() == 1
