"""Raw text in, typed rows out: dirty input, NULLs, whole layers."""

import os

import pytest
from pyspark.sql import functions as F

from catalog_marts.__main__ import main
from catalog_marts.operators import clean_table
from catalog_marts.plans import (
    build_gold,
    build_silver,
    open_published,
    publish,
    raise_on_failure,
)
from catalog_marts.plans.layers import read_silver
from catalog_marts.plans.publish import SERVING_TABLES
from catalog_marts.sources import (
    GOLD_SCHEMAS,
    PRINCIPALS,
    RATINGS,
    SILVER,
    TITLES,
    read_tsv,
    register_views,
    require_tables,
    scratch_copy,
    scratch_scope,
)

HEADER = "\t".join(TITLES.raw_columns)


def titles_from(spark, tmp_path, *lines, header=HEADER):
    path = tmp_path / "title.basics.tsv"
    path.write_text("\n".join([header, *lines]) + "\n")
    return clean_table(read_tsv(spark, str(path)), TITLES).orderBy("title_id").collect()


def line(tid="t", kind="movie", title="x", orig="x", adult="0", start="2000", end="\\N",
         runtime="90", genres="Drama"):
    return "\t".join([tid, kind, title, orig, adult, start, end, runtime, genres])


def test_titles_keep_quotes_and_backslashes(spark, tmp_path):
    texts = ['"Rome" x', '"Unclosed', '"Closed"', "end\\", "it's", "a \\N b"]
    got = titles_from(spark, tmp_path, *[line(f"t{i}", title=t) for i, t in enumerate(texts)])
    assert [r.primary_title for r in got] == texts
    assert {(r.original_title, r.start_year, r.genres) for r in got} == {("x", 2000, "Drama")}


def test_null_and_empty_fields(spark, tmp_path):
    got = titles_from(spark, tmp_path, line("t1", title="\\N", genres="\\N"), line("t2", title=""))
    assert [r.primary_title for r in got] == [None, None]
    assert got[0].genres is None and got[0].end_year is None


def test_digits_stay_text(spark, tmp_path):
    got = titles_from(spark, tmp_path, line("t1", title="007"), line("t2", title="1984"))
    assert [r.primary_title for r in got] == ["007", "1984"]


@pytest.mark.parametrize("others", [[], ["zz"]])
def test_flag_does_not_depend_on_other_rows(spark, tmp_path, others):
    flags = ["0", "1", "2019", "\\N", *others]
    got = titles_from(spark, tmp_path, *[line(f"t{i}", adult=f) for i, f in enumerate(flags)])
    assert [r.is_adult for r in got] == [False, True, True, None] + [None] * len(others)


def test_lenient_numbers(spark, tmp_path):
    years = ["x", "99999999999", " 12 ", "2000.5", "-5"]
    got = titles_from(spark, tmp_path, *[line(f"t{i}", start=y) for i, y in enumerate(years)])
    assert [r.start_year for r in got] == [None, None, 12, None, -5]


def test_short_and_long_lines(spark, tmp_path):
    got = titles_from(spark, tmp_path, "t1\tmovie\tonly", line("t2") + "\textra")
    assert got[0].primary_title == "only" and got[0].genres is None
    assert got[1].genres == "Drama"


def test_columns_are_found_by_name(spark, tmp_path):
    header = "extra\t" + "\t".join(reversed(TITLES.raw_columns))
    row = "zzz\t" + "\t".join(reversed(line("t1", title="Name").split("\t")))
    got = titles_from(spark, tmp_path, row, header=header)
    assert (got[0].title_id, got[0].primary_title, got[0].start_year) == ("t1", "Name", 2000)


def test_list_marks_are_removed(spark, tmp_path):
    got = titles_from(spark, tmp_path, line(genres='["Drama", "Sci-Fi"]'))
    assert got[0].genres == "Drama,Sci-Fi"
    raw = spark.createDataFrame([("t", "1", "n", "actor", "j", '["Self","The Host"]')],
                                PRINCIPALS.raw_columns)
    assert clean_table(raw, PRINCIPALS).first().characters == "Self,The Host"


def test_clean_types(spark):
    for spec in SILVER.values():
        raw = spark.createDataFrame([], ", ".join(f"{c} string" for c in spec.raw_columns))
        got = clean_table(raw, spec)
        assert ", ".join(f"{n} {t}" for n, t in got.dtypes) == spec.schema


def test_clean_is_one_projection(spark):
    raw = spark.createDataFrame([], ", ".join(f"{c} string" for c in RATINGS.raw_columns))
    plan = clean_table(raw, RATINGS)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") == 1


def test_missing_tables_are_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="one .*two"):
        require_tables(spark, {"one": str(tmp_path / "1"), "two": str(tmp_path / "2")})


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """All layers built from hand-written dumps."""
    root = tmp_path_factory.mktemp("catalogue")
    dumps = {
        "name.basics.tsv": ["nconst\tprimaryName\tbirthYear\tdeathYear\tprimaryProfession"
                            "\tknownForTitles",
                            "nm1\tAnn\t1950\t\\N\tactress\ttt1", "nm2\tBob\t\\N\t\\N\t\\N\t\\N"],
        "title.principals.tsv": ["tconst\tordering\tnconst\tcategory\tjob\tcharacters",
                                 'tt1\t1\tnm1\tactress\t\\N\t["Self","The Host"]',
                                 "tt1\t2\tnm2\tdirector\t\\N\t\\N",
                                 "tt2\t1\tnm2\t\\N\t\\N\t\\N"],
        "title.akas.tsv": ["titleId\tordering\ttitle\tregion\tlanguage\ttypes\tattributes"
                           "\tisOriginalTitle",
                           "tt1\t1\tA\tUS\t\\N\t\\N\t\\N\t0", "tt1\t2\tA\t\\N\t\\N\t\\N\t\\N\t1"],
        "title.basics.tsv": [HEADER, line("tt1", title='"Star Wars" tale', genres="Drama,Action"),
                             line("tt2", kind="\\N", start="\\N", genres="\\N")],
        "title.ratings.tsv": ["tconst\taverageRating\tnumVotes", "tt1\t8.7\t200000"],
    }
    for name, lines in dumps.items():
        (root / name).write_text("\n".join(lines) + "\n")
    build_silver(spark, str(root), str(root / "tables"))
    build_gold(spark, str(root / "tables"))
    register_views(spark, str(root / "tables"))
    return root


def test_sql_on_registered_views(spark, built):
    q = """
      select t.start_year, t.title_type, count(*) as n, max(r.num_votes) as votes
      from silver_titles t join silver_ratings r on t.title_id = r.title_id
      group by t.start_year, t.title_type"""
    assert [tuple(r) for r in spark.sql(q).collect()] == [(2000, "movie", 1, 200000)]
    q = """
      select title_type, count(distinct title_id) as n from gold_category_wise_movies
      where lower(primary_title) like '%star wars%' group by title_type"""
    assert [tuple(r) for r in spark.sql(q).collect()] == [("movie", 1)]
    genres = spark.table("gold_category_wise_movies").select("title_type", "genres").collect()
    assert sorted(tuple(r) for r in genres) == [("movie", "Action"), ("movie", "Drama"),
                                                ("unknown", "unknown")]
    cast = spark.table("gold_top_category_wise_cast").select("name_id", "category").collect()
    assert sorted(tuple(r) for r in cast) == [("nm1", "actress"), ("nm2", "director"),
                                              ("nm2", "unknown")]


def test_nulls_survive_to_the_published_table(spark, built):
    target = str(built / "serving")
    tables = {name: spark.table(name) for name in SERVING_TABLES}
    status = publish(spark, tables, target)
    raise_on_failure(status)
    assert {r["table"]: r["rows"] for r in status.collect()} == {
        name: df.count() for name, df in tables.items()}
    titles = open_published(spark, target, "silver_titles").orderBy("title_id").collect()
    assert titles[1].start_year is None and titles[1].title_type is None
    assert titles[0].primary_title == '"Star Wars" tale'
    people = open_published(spark, target, "silver_names").where("birth_year is null")
    mart = open_published(spark, target, "gold_category_wise_movies", GOLD_SCHEMAS["category_wise_movies"])
    plan = mart.where("title_type = 'movie'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(title_type" in plan
    assert all(r["seconds"] > 0 for r in status.collect())
    assert people.count() == 1
    silver = read_silver(spark, str(built / "tables"))
    assert silver["principals"].where("characters = 'Self,The Host'").count() == 1


def test_command_line(spark, built, tmp_path, capsys):
    out, again = str(built / "tables"), str(tmp_path / "again")
    main(["build", "--raw", str(built), "--out", again, "--cluster", "hash"])
    for name in SERVING_TABLES:
        layer, table = name.split("_", 1)
        stored = spark.read.parquet(f"{again}/{layer}/{table}").select(*spark.table(name).columns)
        assert stored.exceptAll(spark.table(name)).count() == 0
        assert stored.count() == spark.table(name).count()
    main(["publish", "--out", out, "--target", str(tmp_path / "serving")])
    assert open_published(spark, str(tmp_path / "serving"), "gold_category_wise_movies").count() == 3
    main(["report", "--out", out, "--reports", str(tmp_path / "reports")])
    for name in ("q1", "q2", "q3", "q4"):
        assert spark.read.option("header", True).csv(str(tmp_path / "reports" / name)).columns
    printed = capsys.readouterr().out
    assert '"Star Wars" tale' in printed and "match_count" in printed and "rank_in_year" in printed
    with pytest.raises(SystemExit):
        main(["publish", "--out", out])


def folder_of(df):
    return df.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:").replace("//", "/")


def test_scratch_belongs_to_a_job(spark):
    mine = scratch_copy(spark.range(5), "x")
    with pytest.raises(ValueError), scratch_scope(spark):
        inside = folder_of(scratch_copy(spark.range(3), "y"))
        assert os.path.exists(inside)
        raise ValueError
    assert not os.path.exists(inside)
    assert mine.count() == 5 and os.path.exists(folder_of(mine))


def test_a_failed_publish_leaves_the_earlier_copy(spark, tmp_path):
    target = str(tmp_path / "serving")
    raise_on_failure(publish(spark, {"t": spark.range(4)}, target))
    bad = spark.range(9).selectExpr("if(id > 5, cast(raise_error('broken') as bigint), id) as id")
    assert publish(spark, {"t": bad}, target).first().ok is False
    assert open_published(spark, target, "t").count() == 4
    raise_on_failure(publish(spark, {"t": spark.range(7)}, target))
    assert open_published(spark, target, "t").count() == 7


def test_parts_with_other_headers_fail(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.tsv").write_text("a\tb\n1\t2\n")
    (tmp_path / "d" / "2.tsv").write_text("b\ta\n3\t4\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_tsv(spark, str(tmp_path / "d")).collect()


def test_carriage_returns(spark, tmp_path):
    (tmp_path / "lone.tsv").write_bytes(b"a\tb\nx\ry\t1\n")
    assert [tuple(r) for r in read_tsv(spark, str(tmp_path / "lone.tsv")).collect()] == [("x\ry", "1")]
    (tmp_path / "crlf.tsv").write_bytes(b"a\tb\r\nx\t1\r\ny\t\\N\r\n")
    got = read_tsv(spark, str(tmp_path / "crlf.tsv"))
    assert got.columns == ["a", "b"]
    assert [tuple(r) for r in got.collect()] == [("x", "1"), ("y", None)]


def test_long_reports_are_printed_whole(spark, silver_like, tmp_path, capsys):
    out = silver_like
    main(["report", "--out", out, "--reports", str(tmp_path)])
    printed = capsys.readouterr().out
    years = [int(line.split("\t")[0]) for line in printed.split("q2\t")[0].splitlines()[1:]]
    assert len(years) == 40
    stored = [int(r["start_year"]) for r in spark.read.option("header", True).csv(f"{tmp_path}/q1").collect()]
    assert stored == years


@pytest.fixture
def silver_like(spark, built, tmp_path):
    """The built tables with titles of 40 years."""
    root = str(tmp_path / "tables")
    for name in SERVING_TABLES:
        layer, table = name.split("_", 1)
        source = spark.read.parquet(f"{built}/tables/{layer}/{table}")
        if name in ("silver_titles", "silver_ratings"):
            one = source.where("title_id is not null").limit(1)
            source = one.crossJoin(spark.range(40)).withColumn("title_id", F.concat(F.lit("t"), "id"))
            if name == "silver_titles":
                source = source.withColumn("start_year", (F.col("id") + 1981).cast("int"))
            source = source.drop("id")
        source.write.parquet(f"{root}/{layer}/{table}")
    return root


def test_one_failing_table_does_not_stop_the_others(spark, tmp_path):
    good = spark.range(10)
    bad = spark.range(10).selectExpr("cast(raise_error('broken input') as bigint) as id")
    status = publish(spark, {"a": good, "b": bad, "c": good}, str(tmp_path), parallelism=2)
    got = {r["table"]: (r["rows"], r["ok"]) for r in status.collect()}
    assert got == {"a": (10, True), "b": (None, False), "c": (10, True)}
    assert "broken input" in status.where("table = 'b'").first().error
    with pytest.raises(RuntimeError, match="not published: b$"):
        raise_on_failure(status)
