"""Rejects of a dump: the same table as without them, and where each value stands."""

import pytest

from catalog_marts.operators import clean_table, clean_with_rejects
from catalog_marts.sources import RATINGS, TITLES, read_tsv

HEADER = "tconst\taverageRating\tnumVotes"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def dump(tmp_path, **files):
    for name, lines in files.items():
        (tmp_path / f"{name}.tsv").write_text("\n".join([HEADER, *lines]) + "\n", newline="")
    return str(tmp_path)


def rejects(df):
    return sorted((r.file.rsplit("/", 1)[1], r.line, r.column, r.raw, r.reason) for r in df.collect())


def test_values_and_lines(spark, tmp_path):
    path = dump(
        tmp_path,
        a=["t1\t5.5\t10", "t2\tx\t99999999999", "t3\t\\N\t", 't4\t"7"\t1.5', "t5\t1", "", "t6\t1\t2\t3", HEADER, "t7\t2\t 12 "],
        b=["t8\tNaN\t1", "t9\té\t1"],
    )
    table, bad = clean_with_rejects(spark, path, RATINGS)
    assert rejects(bad) == sorted([
        ("a.tsv", 3, "averageRating", "x", "no float"),
        ("a.tsv", 3, "numVotes", "99999999999", "no int"),
        ("a.tsv", 5, "averageRating", '"7"', "no float"),
        ("a.tsv", 5, "numVotes", "1.5", "no int"),
        ("a.tsv", 6, "fields", "t5\t1", "found 2 of 3 fields"),
        ("a.tsv", 7, "fields", "", "found 1 of 3 fields"),
        ("a.tsv", 8, "fields", "t6\t1\t2\t3", "found 4 of 3 fields"),
        ("a.tsv", 9, "averageRating", "averageRating", "no float"),
        ("a.tsv", 9, "numVotes", "numVotes", "no int"),
        ("b.tsv", 3, "averageRating", "é", "no float"),
    ])
    assert table.count() == 11 and table.columns == ["title_id", "average_rating", "num_votes"]


def test_same_table_as_plain_cleaning(spark, tmp_path):
    path = dump(tmp_path, a=["t1\t5.5\t10", "t2\tx\t7", "t3\t\\N\t", 't4\t"7"\t1'], b=["t8\t1\t1"])
    table, _ = clean_with_rejects(spark, path, RATINGS)
    assert rows_of(table) == rows_of(clean_table(read_tsv(spark, path), RATINGS))


def test_line_numbers_over_many_splits(spark, tmp_path, conf):
    conf(spark__sql__files__maxPartitionBytes="2000", spark__sql__files__openCostInBytes="1")
    path = dump(tmp_path, a=[f"t{i}\t{'bad' if i % 97 == 0 else i % 10}\t{i}" for i in range(5000)], b=[f"u{i}\t1\t{i}" for i in range(3000)] + ["u\t1\tz"])
    table, bad = clean_with_rejects(spark, path, RATINGS)
    assert table.rdd.getNumPartitions() >= 1 and table.count() == 8001
    assert rejects(bad) == sorted(
        [("a.tsv", i + 2, "averageRating", "bad", "no float") for i in range(0, 5000, 97)] + [("b.tsv", 3002, "numVotes", "z", "no int")]
    )


def test_carriage_returns(spark, tmp_path):
    (tmp_path / "a.tsv").write_bytes(b"tconst\taverageRating\tnumVotes\r\nt1\t1.5\t2\r\nt2\t1\tx\r\n")
    table, bad = clean_with_rejects(spark, str(tmp_path), RATINGS)
    assert rows_of(table) == [("t1", 1.5, 2), ("t2", 1.0, None)]
    assert rejects(bad) == [("a.tsv", 3, "numVotes", "x", "no int")]


def test_headers(spark, tmp_path):
    path = dump(tmp_path, a=["t1\t1\t1"])
    (tmp_path / "b.tsv").write_text("tconst\tnumVotes\taverageRating\nt2\t1\t1\n")
    with pytest.raises(ValueError, match="another header"):
        clean_with_rejects(spark, path, RATINGS)
    with pytest.raises(ValueError, match="no column"):
        clean_with_rejects(spark, f"{path}/a.tsv", TITLES)
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "x.tsv").write_text("")
    with pytest.raises(ValueError, match="no lines"):
        clean_with_rejects(spark, str(tmp_path / "empty"), RATINGS)


def test_header_alone(spark, tmp_path):
    table, bad = clean_with_rejects(spark, dump(tmp_path, a=[]), RATINGS)
    assert table.count() == bad.count() == 0
