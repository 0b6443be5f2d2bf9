"""Clustering on several keys: the same rows, and files that can be skipped on each of them."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from catalog_marts.sources import write_table
from catalog_marts.sources.curve import curve_position

KEYS = ["a", "b", "c"]


def table(spark, n=20_000):
    hashed = lambda seed, size: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(size))
    c = F.concat(F.lit("k"), F.lpad(hashed(3, 500).cast("string"), 4, "0"))
    return spark.range(n, numPartitions=6).select(
        "id", hashed(1, 1000).cast("int").alias("a"), F.when(hashed(9, 10) > 0, hashed(2, 700) / 7.0).alias("b"), c.alias("c")
    )


def touched(path, column, value):
    """Files whose range holds the value."""
    count, files = 0, glob.glob(f"{path}/*.parquet")
    for file in files:
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(column)
        groups = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        count += any(s.min <= value <= s.max for s in groups)
    return count, len(files)


def test_files_are_skipped_on_every_key(spark, tmp_path, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    df = table(spark)
    curve, plain = str(tmp_path / "curve"), str(tmp_path / "plain")
    write_table(df, curve, sort_by=KEYS, n_files=27, cluster="curve")
    write_table(df, plain, sort_by=KEYS, n_files=27)
    for column, value in (("a", 333), ("b", 40.0), ("c", "k0100")):
        few, files = touched(curve, column, value)
        assert files >= 20 and few <= 0.6 * files, column
    assert touched(plain, "b", 40.0)[0] > 20 and touched(plain, "c", "k0100")[0] > 20
    both = spark.read.parquet(curve)
    assert both.count() == df.count() and both.exceptAll(df).isEmpty() and both.columns == df.columns


def test_a_value_with_most_rows_and_nulls(spark, tmp_path):
    df = table(spark, 5000).withColumn("a", F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("a")))
    df = df.unionByName(spark.createDataFrame([(i, None, None, None) for i in range(50)], "id long, a int, b double, c string"))
    write_table(df, str(tmp_path / "t"), sort_by=KEYS, cluster="curve")
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 5050 and back.exceptAll(df).isEmpty()


def test_positions(spark):
    df = spark.range(64).selectExpr("cast(id % 8 as int) as x", "cast(id div 8 as int) as y")
    at = {(r.x, r.y): r.z for r in df.select("x", "y", curve_position(df, ["x", "y"], bits=3).alias("z")).collect()}
    assert len(set(at.values())) == 64
    quarter = sorted(at[x, y] for x in range(4) for y in range(4))
    assert quarter == list(range(quarter[0], quarter[0] + 16))  # a square of the table is a range of the curve


def test_wrong_numbers_of_keys_and_empty_tables(spark, tmp_path):
    df = table(spark, 10)
    with pytest.raises(ValueError):
        curve_position(df, ["a"])
    write_table(df.limit(0), str(tmp_path / "e"), sort_by=["a", "b"], cluster="curve")
    assert spark.read.schema(df.schema).parquet(str(tmp_path / "e")).count() == 0
    with pytest.raises(ValueError):
        write_table(df, str(tmp_path / "x"), sort_by=["a desc", "b"], cluster="curve")
