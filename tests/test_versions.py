"""Publishing by difference: what is written, what stays, what is removed, and the content check."""

import os

import pytest
from pyspark.sql import functions as F

from catalog_marts.plans import open_version, publish_changes, verify_version
from catalog_marts.plans.versions import _arrived, fingerprints, versions

SCHEMA = "id long, kind string, year int, score double"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files_below(folder):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")
    }


def actions(status):
    return {r["part"]: (r["action"], r["rows"]) for r in status.collect()}


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "table")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fingerprints_are_the_sums_of_hashes(spark):
    df = spark.range(3000).selectExpr("id % 7 as g", "if(id % 5 = 0, null, id) as x", "cast(id as string) as y")
    of = ["g is null", "g", "x is null", "x", "y is null", "y"]
    want = df.selectExpr("g", f"cast(xxhash64({', '.join(of)}) as decimal(20,0)) as a", f"cast(xxhash64('b', {', '.join(of)}) as decimal(20,0)) as b")
    wrap = "18446744073709551616BD"
    want = want.groupBy("g").agg(F.count("*"), F.expr(f"pmod(sum(a), {wrap})"), F.expr(f"pmod(sum(b), {wrap})"))
    assert rows_of(fingerprints(df, F.col("g"))) == rows_of(want)


def test_what_arrived_is_read_once_without_sorting(spark, root):
    df = spark.createDataFrame([(i, "k%s/=" % (i % 3), 1990, i / 7) for i in range(50)], SCHEMA).repartition(4)
    publish_changes(df, root, ["kind"], ["year"])
    found = _arrived(spark, f"{root}/data-0000000001", df.schema, ["kind"], 32)
    plan = plan_of(found)
    assert plan.count("FileScan") == 1 and plan.count("SortAggregate") <= 2  # of partitions, not of rows
    assert "HashAggregate(keys=[kind" in plan
    assert {r["rows"] for r in found.collect()} == {17, 16}


def test_only_changed_partitions_are_written(spark, root):
    rows = [(1, "a b/c=%", 1990, 1.5), (2, "a b/c=%", 1991, None), (3, "é+", 1990, 2.0), (4, None, None, 0.1), (5, "gone", 2000, 1.0)]
    first = publish_changes(spark.createDataFrame(rows, SCHEMA), root, ["kind"], ["year desc"])
    assert {a for a, _ in actions(first).values()} == {"written"}
    before = files_below(f"{root}/data-0000000001")
    changed = [rows[1], rows[0], (3, "é+", 1990, 2.5), rows[3], (6, "new", 1, 1.0)]
    again = publish_changes(spark.createDataFrame(changed, SCHEMA).repartition(3), root, ["kind"], ["year desc"])
    assert actions(again) == {
        '{"kind":"a b/c=%"}': ("kept", 2), '{"kind":"é+"}': ("written", 1), '{"kind":"unknown"}': ("kept", 1),
        '{"kind":"gone"}': ("removed", 1), '{"kind":"new"}': ("written", 1),
    }
    stored = [(i, kind or "unknown", y, s) for i, kind, y, s in changed]
    assert rows_of(open_version(spark, root)) == sorted(stored, key=repr)
    assert open_version(spark, root).columns == ["id", "kind", "year", "score"]
    assert rows_of(open_version(spark, root, 1)) == sorted([(i, kind or "unknown", y, s) for i, kind, y, s in rows], key=repr)
    assert files_below(f"{root}/data-0000000001") == before  # untouched
    assert not [f for f in files_below(f"{root}/data-0000000002") if "b/c" in f or "unknown" in f]
    assert all(r.ok for r in verify_version(spark, root).collect())


def test_old_versions_and_their_folders_go(spark, root):
    frame = lambda n: spark.range(12).selectExpr("id", "concat('k', id % 3) as kind", f"if(id % 3 = {n} % 3, {n}, 0) as x")
    for n in range(1, 5):
        publish_changes(frame(n), root, ["kind"], keep=2)
    assert versions(spark, root) == [3, 4]
    for n in (3, 4):
        assert rows_of(open_version(spark, root, n)) == rows_of(frame(n))
    listed = {f.split("/table/")[1].rsplit("/", 1)[0] for n in (3, 4) for f in open_version(spark, root, n).inputFiles()}
    assert {f.split("/table/")[1].rsplit("/", 1)[0] for f in files_below(root) if "/data-" in f} == listed
    publish_changes(frame(4), root, ["kind"], keep=1)
    assert versions(spark, root) == [5] and rows_of(open_version(spark, root)) == rows_of(frame(4))


def test_tables_without_partitions_are_split_by_key(spark, root):
    table = spark.range(500).selectExpr("id", "id * 2 as x")
    publish_changes(table, root, sort_by=["id"], buckets=8)
    again = publish_changes(table.withColumn("x", F.expr("if(id = 77, null, x)")), root, sort_by=["id"], buckets=8)
    assert sorted(a for a, _ in actions(again).values()) == ["kept"] * 7 + ["written"]
    assert open_version(spark, root).columns == ["id", "x"] and open_version(spark, root).where("x is null").first().id == 77
    assert sum(n for _, n in actions(again).values()) == 500
    other = publish_changes(open_version(spark, root), root, sort_by=["id"], buckets=4)
    assert sorted(a for a, _ in actions(other).values()) == ["removed"] * 8 + ["written"] * 4


def test_other_columns_rewrite_everything(spark, root):
    publish_changes(spark.range(5).selectExpr("id", "'a' as k"), root, ["k"])
    again = publish_changes(spark.range(5).selectExpr("id as key", "'a' as k"), root, ["k"])
    assert set(actions(again).values()) == {("written", 5)}
    assert rows_of(open_version(spark, root)) == [(i, "a") for i in range(5)]


def test_failures_leave_the_current_version(spark, root):
    publish_changes(spark.range(4), root)
    with pytest.raises(Exception, match="broken"):
        publish_changes(spark.range(9).selectExpr("if(id > 5, cast(raise_error('broken') as bigint), id) as id"), root)
    assert versions(spark, root) == [1] and open_version(spark, root).count() == 4
    os.makedirs(f"{root}/data-0000000002/left")
    publish_changes(spark.range(5), root)
    assert versions(spark, root) == [1, 3] and not os.path.exists(f"{root}/data-0000000002")
    with pytest.raises(FileNotFoundError):
        open_version(spark, f"{root}-none")


def test_an_overtaken_publisher_gives_up(spark, root, monkeypatch):
    from catalog_marts.plans import versions as module

    publish_changes(spark.range(3), root)
    write = module.write_table

    def slow(df, *args):
        monkeypatch.setattr(module, "write_table", write)
        publish_changes(spark.range(8), root)  # another one, meanwhile
        write(df, *args)

    monkeypatch.setattr(module, "write_table", slow)
    with pytest.raises(Exception, match="overtaken|not what was sent|PATH_NOT_FOUND"):
        publish_changes(spark.range(6), root)
    assert open_version(spark, root).count() == 8 and all(r.ok for r in verify_version(spark, root).collect())


def test_written_content_is_compared(spark, root, monkeypatch):
    from catalog_marts.plans import versions as module

    write = module.write_table
    monkeypatch.setattr(module, "write_table", lambda df, *args: write(df.withColumn("x", F.col("x") + F.expr("if(id = 3, 1, 0)")), *args))
    with pytest.raises(RuntimeError, match="not what was sent"):
        publish_changes(spark.range(9).selectExpr("id", "id as x"), root)
    assert versions(spark, root) == [] and not files_below(root)


def test_verify_finds_lost_and_changed_files(spark, root):
    publish_changes(spark.range(9).selectExpr("id", "concat('k', id % 3) as kind"), root, ["kind"])
    spark.range(1).selectExpr("id + 100 as id").coalesce(1).write.mode("append").parquet(f"{root}/data-0000000001/kind=k1")
    assert {r["part"]: r.ok for r in verify_version(spark, root).collect()} == {
        '{"kind":"k0"}': True, '{"kind":"k1"}': False, '{"kind":"k2"}': True,
    }


def test_fingerprints_follow_content_not_order(spark):
    of = lambda rows: fingerprints(spark.createDataFrame(rows, "a string, b string, c double").repartition(3), F.lit(1)).first()[1:]
    one = of([("x", None, 0.1 + 0.2), ("y", "z", None), ("y", "z", None)])
    assert one == of([("y", "z", None), ("x", None, 0.3), ("y", "z", None)])
    assert one != of([(None, "x", 0.3), ("y", "z", None), ("y", "z", None)])
    assert one != of([("x", None, 0.3), ("y", "z", None)])
    assert of([("x", "y", 0.0), ("u", "v", 0.0)]) != of([("x", "v", 0.0), ("u", "y", 0.0)])


def test_empty_tables(spark, root):
    empty = spark.createDataFrame([], SCHEMA)
    assert actions(publish_changes(empty, root, ["kind"])) == {}
    assert open_version(spark, root).schema == empty.schema and verify_version(spark, root).count() == 0
    publish_changes(spark.createDataFrame([(1, "a", 1, 1.0)], SCHEMA), root, ["kind"])
    assert actions(publish_changes(empty, root, ["kind"])) == {'{"kind":"a"}': ("removed", 1)}
    assert open_version(spark, root).count() == 0
