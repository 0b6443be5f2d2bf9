"""Results stay whole when tasks fail half-way and run again."""

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from catalog_marts.operators import dense_rank_spread, left_join_spread
from catalog_marts.sources import scratch_dir, write_table
from tests.expected import dense_rank_window

SF = "/root/testdata/sf0.001"


def fails_once(batches):
    """Pass the rows on, but lose every other task after its last row the first time."""
    yield from batches
    context = TaskContext.get()
    if context.attemptNumber() == 0 and context.partitionId() % 2 == 1:
        raise RuntimeError("task lost on purpose")


def rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    steady = spark.read.parquet(f"{SF}/lineitem.parquet").repartition(6, "l_orderkey").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.when(F.col("l_returnflag") != "A", 1).otherwise(F.col("l_partkey")).alias("k"),
        F.when(F.col("l_returnflag") != "R", "hot").otherwise("cold").alias("g"),
    )
    return steady, steady.mapInPandas(fails_once, steady.schema)


def test_spread_join(tables):
    steady, shaky = tables
    right = steady.groupBy("k").agg(F.sum("l_quantity").alias("q"))
    assert rows(left_join_spread(shaky, "k", right)) == rows(steady.join(right, "k", "left"))


def test_spread_rank(tables):
    steady, shaky = tables
    assert rows(dense_rank_spread(shaky, "g", "l_quantity", chunks=9)) == rows(
        dense_rank_window(steady, "g", "l_quantity"))


@pytest.mark.parametrize("options", [
    {"sort_by": ["k", "l_quantity desc"]},
    {"sort_by": "k", "cluster": "hash"},
    {"partition_by": "g", "sort_by": "l_quantity"},
])
def test_sinks(spark, tables, options):
    steady, shaky = tables
    path = scratch_dir(spark, "retry")
    write_table(shaky, path, **options)
    assert rows(spark.read.parquet(path)) == rows(steady)
