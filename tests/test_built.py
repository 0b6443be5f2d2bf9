"""How the layers of a query are built: tables at the same time, places without a shuffle of lines."""

from threading import Barrier

import __spark_entry__ as entry
from catalog_marts.fixtures import raw_table
from catalog_marts.sources import SILVER


def test_places_join_without_a_shuffle_of_all_lines(spark, conf, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="50000")  # more than the places, less than the lines
    rows = {
        "lineitem": ("l_suppkey long, l_partkey long, l_linenumber int, l_returnflag string, l_linestatus string",
                     [(1, 7, 1, "A", "F"), (2, 8, 2, "N", "O"), (9, 8, 3, "N", "O"), (None, 8, 4, "R", "F")]),
        "supplier": ("s_suppkey long, s_nationkey int", [(1, 10), (2, 11), (2, 10), (3, None)]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(10, "KENYA", 0), (11, "INDIA", 2)]),
        "region": ("r_regionkey int, r_name string", [(0, "AFRICA"), (2, "ASIA")]),
    }
    for name, (schema, values) in rows.items():
        made = spark.createDataFrame(values, schema)
        if name == "lineitem":  # and many lines of suppliers that are not there
            more = spark.range(100, 50_100).selectExpr("id", "id", "1", "'A'", "'F'")
            made = made.union(more).coalesce(1)
        made.write.parquet(f"{tmp_path}/{name}.parquet")
    akas = raw_table(spark, str(tmp_path), "akas")
    found = sorted((r.titleId, r.title, r.region, r.language) for r in akas.collect())
    assert found == sorted([
        ("tt7", "KENYA cut", "Unknown", "africa"), ("tt8", "INDIA cut", None, "asia"), ("tt8", "KENYA cut", "KENYA", "africa"),
    ], key=str)
    plan = akas._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan


def test_dumps_and_cleaned_tables_are_made_at_the_same_time(spark, monkeypatch):
    together, dumped, built = Barrier(len(SILVER)), [], []

    def write(table, path):
        together.wait(30)
        dumped.append((table, path))

    monkeypatch.setattr(entry, "raw_table", lambda s, d, name: f"{d}/{name}")
    monkeypatch.setattr(entry, "write_dump", write)
    monkeypatch.setattr(entry, "build_silver", lambda s, raw, out, **options: built.append((raw, out, options)))
    monkeypatch.setattr(entry, "build_gold", lambda s, root: built.append(root))
    root = entry._built(spark, "given")
    assert sorted(dumped) == sorted((f"given/{n}", f"{root}/raw/{s.file}") for n, s in SILVER.items())
    assert built == [(f"{root}/raw", root, {"parallelism": len(SILVER)}), root]
