"""Stored reports keep their order."""

import pytest
from pyspark.sql import functions as F

from catalog_marts.plans import open_report, store_report


def test_order_over_many_files(spark, tmp_path, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="7")
    report = spark.range(500).select((F.col("id") * 37 % 500).alias("x"), "id").orderBy(F.desc("x"))
    store_report(report, str(tmp_path / "r"))
    assert len(list((tmp_path / "r").glob("*.parquet"))) > 3
    got = open_report(spark, str(tmp_path / "r"))
    assert got.columns == ["x", "id", "position"]
    assert sorted((r.position, r.x) for r in got.collect()) == [(i + 1, 499 - i) for i in range(500)]


def test_empty_and_clashing(spark, tmp_path):
    store_report(spark.range(0), str(tmp_path / "r"))
    assert open_report(spark, str(tmp_path / "r")).count() == 0
    with pytest.raises(ValueError):
        store_report(spark.range(1).withColumnRenamed("id", "position"), str(tmp_path / "s"))
