"""Key contracts: the filter proves, the anti-join decides, and both frames agree."""

import pytest
from pyspark.sql import functions as F

from catalog_marts.plans import check_keys, raise_on_broken_keys
from catalog_marts.plans.contracts import FILTER_BITS, Relationship, key_filter, may_hold, orphans

REL = Relationship("a", "k", "b", "id")


def report_of(spark, left, right, **options):
    tables = {"a": spark.createDataFrame([(x,) for x in left], "k string"), "b": spark.createDataFrame([(x,) for x in right], "id string")}
    report, lost = check_keys(tables, [REL], **options)
    return report.first().asDict(), sorted((r["key"], r["rows"]) for r in lost.collect()), report


def test_counts_and_orphans(spark):
    got, lost, report = report_of(spark, ["x", "x", "y", None, "z", "z", "z", ""], ["x", "y", "y", "y", "w", None, None])
    assert got == {
        "relationship": "a.k -> b.id", "rows": 8, "null_rows": 1, "keys": 4, "orphan_keys": 2, "orphan_rows": 4,
        "right_keys": 3, "duplicate_keys": 1, "duplicate_rows": 2,
    }
    assert lost == [("", 1), ("z", 3)]
    with pytest.raises(RuntimeError, match="a.k -> b.id"):
        raise_on_broken_keys(report)


def test_empty_sides(spark):
    got, lost, report = report_of(spark, [], ["x"])
    assert (got["rows"], got["keys"], got["right_keys"], lost) == (0, 0, 1, [])
    raise_on_broken_keys(report)
    got, lost, _ = report_of(spark, ["x", None], [])
    assert (got["orphan_keys"], got["right_keys"], lost) == (1, 0, [("x", 1)])


@pytest.mark.parametrize("bits", [15, 16, FILTER_BITS])
def test_exact_however_full_the_filter(spark, bits):
    """With 2 ** 15 bits and 20,000 keys nearly everything passes the filter; the join decides."""
    left = spark.range(30_000).selectExpr("concat('k', id) as key", "id % 3 + 1 as rows")
    right = spark.range(20_000).selectExpr("concat('k', id) as key")
    found = orphans(left, right, bits)
    assert found.count() == 10_000 and found.where("cast(substring(key, 2) as int) < 20000").isEmpty()
    assert found.agg(F.sum("rows")).first()[0] == sum(i % 3 + 1 for i in range(20_000, 30_000))
    passed = may_hold(left, "key", key_filter(right, "key", bits), bits).where("_may")
    assert passed.where("cast(substring(key, 2) as int) < 20000").count() == 20_000  # never a matched key lost
    more = passed.count() - 20_000
    assert (more > 3000) if bits == 15 else (more < 6000) if bits == 16 else (more < 20)


def test_filter_size_is_fixed(spark):
    for n in (10, 50_000):
        built = key_filter(spark.range(n), "id", 17)
        assert built.count() <= 4 and built.agg(F.max(F.octet_length("_bits"))).first()[0] == 4096
    with pytest.raises(ValueError):
        key_filter(spark.range(1), "id", 3)


def test_hot_keys_are_counted_in_the_reading_tasks(spark):
    left = spark.range(100_000, numPartitions=8).selectExpr("if(id % 3 > 0, 'hot', concat('k', id)) as k")
    report, lost = check_keys({"a": left, "b": spark.createDataFrame([("hot",)], "id string")}, [REL])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert report.first()["orphan_rows"] == lost.count() == 33_334
