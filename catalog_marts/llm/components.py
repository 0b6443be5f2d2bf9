"""Connected components of links between ids, without any of them on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_marts.sources import scratch_copy


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``component`` (the smallest id reachable) of ids that a smaller id reaches.

    Ids missing from the result are the smallest of their component, or have no link. Rounds:
    every id hooks to its smallest neighbour, the trees that this makes are flattened by pointer
    jumping, and links are rewritten between the roots. Ids that hook vanish, and of the others
    no two are linked in the next round unless their trees were, so rounds are few. Every step is
    an aggregate that combines before the shuffle or a join of two stored tables, which adaptive
    execution splits where one id has most links; stored tables also end the lineage of a round.
    Null ids link nothing.
    """
    def ordered(links: DataFrame, a: str, b: str) -> DataFrame:
        links = links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        return scratch_copy(links.where("hi <> lo").distinct(), "links")

    links = ordered(links.where(f"`{a}` is not null and `{b}` is not null"), a, b)
    found = None
    while not links.isEmpty():
        hooks = links.groupBy(F.col("hi").alias("id")).agg(F.min("lo").alias("root"))
        hooks = scratch_copy(hooks, "hooks")
        while True:
            above = hooks.select(F.col("id").alias("root"), F.col("root").alias("_above"))
            raised = scratch_copy(hooks.join(above, "root", "left"), "hooks")
            moved = raised.where("_above is not null")
            done = moved.isEmpty()
            hooks = raised.select("id", F.coalesce("_above", "root").alias("root"))
            if done:
                break
        lower = hooks.select(F.col("id").alias("component"), "root")
        if found is not None:
            found = found.join(lower, "component", "left")
            found = found.select("id", F.coalesce("root", "component").alias("component"))
            found = found.unionByName(hooks.select("id", F.col("root").alias("component")))
        else:
            found = hooks.select("id", F.col("root").alias("component"))
        found = scratch_copy(found, "components")
        for end in ("hi", "lo"):
            new = hooks.select(F.col("id").alias(end), F.col("root").alias("_new"))
            links = links.join(new, end, "left").withColumn(end, F.coalesce("_new", end)).drop("_new")
        links = ordered(links, "hi", "lo")
    if found is None:
        found = links.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return found
