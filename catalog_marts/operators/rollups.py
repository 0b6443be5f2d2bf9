"""Per-title list rollups: who worked on it, and where it was released."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_marts.sources.writers import scratch_copy

# Output column -> credited categories.
CREW_ROLES: dict[str, list[str]] = {
    "actors": ["actor", "actress"],
    "directors": ["director"],
    "producers": ["producer"],
}
NO_REGION = "Unknown"  # fixed value

LARGE_CAST = 10_000  # credits from which a title's lists are put together from pieces


def _listed(text: str, order_by: str) -> Column:
    """Comma list of ``text`` in the given order; NULL entries are skipped, none gives NULL."""
    return F.expr(f"listagg({text}, ',') within group (order by {order_by})")


def crew_rollup(
    principals: DataFrame,
    names: DataFrame,
    roles: Mapping[str, Sequence[str]] = CREW_ROLES,
    large: int = LARGE_CAST,
) -> DataFrame:
    """One row per title in ``principals`` with a comma list of names per role.

    Names appear in billing order (``ordering``, NULL first, then the name). A role nobody fills is the
    empty string; a credit whose person is unknown is skipped.

    Only credits in a listed role need a name, so the others skip the join and merely bring
    their title along. The join itself has a plain scan on both sides, which lets adaptive
    execution split a person with very many credits. Titles with more than ``large`` credits are
    found by a count, which runs when this is called. Theirs are range-partitioned by title, order
    and name, so that one title's credits lie in many tasks, also without billing positions or with
    equal ones; each task strings a piece together, and the last one only joins finished pieces.

    The join leaves a title's credits in as many tasks as it has people, so lists begun there would
    hold one name each, and be sorted, packed and unpacked for nothing: the plain rows are brought
    together by title, and the lists are made once. Other titles pass as one row each.
    """
    listed_categories = sorted(set(chain.from_iterable(roles.values())))
    is_listed = F.col("category").isin(listed_categories)

    people = names.select("name_id", "primary_name")
    listed = (
        principals.where(is_listed)
        .select("title_id", "ordering", "category", "name_id")
        .join(people, "name_id", "left")
        .drop("name_id")
    )
    others = principals.where(~is_listed | F.col("category").isNull()).select("title_id").distinct()
    credits = listed.unionByName(others, allowMissingColumns=True)

    in_role = {
        role: F.when(F.col("category").isin(list(cats)), F.col("primary_name"))
        for role, cats in roles.items()
    }
    credits = credits.select("title_id", "ordering", "primary_name", *[name.alias(role) for role, name in in_role.items()])

    def lists(rows: DataFrame, by: Sequence[str], order_by: str) -> DataFrame:
        return rows.groupBy(*by).agg(*[_listed(f"`{role}`", order_by.format(role=role)).alias(role) for role in roles])

    billing = "ordering, `{role}`"
    counts = principals.groupBy("title_id").agg(F.count(F.lit(1)).alias("_credits"))
    big = scratch_copy(counts.where(F.col("_credits") > large).select(F.col("title_id").alias("_big")), "large-casts")
    if big.isEmpty():
        found = lists(credits.repartition("title_id"), ["title_id"], billing)
    else:
        same = F.col("title_id").eqNullSafe(F.col("_big"))
        found = lists(credits.join(big, same, "left_anti").repartition("title_id"), ["title_id"], billing)
        found = found.unionByName(lists(_pieces(credits.join(big, same, "left_semi"), lists, billing), ["title_id"], "_span"))
    return found.select("title_id", *[F.coalesce(F.col(f"`{role}`"), F.lit("")).alias(role) for role in roles])


def _pieces(credits: DataFrame, lists, billing: str) -> DataFrame:
    """Lists of consecutive credits of a title, numbered by the task that has them. The reading
    task's number is the last range key, so that equal credits can be split, too.
    """
    order = [F.col("title_id"), F.col("ordering").asc_nulls_first(), F.col("primary_name").asc_nulls_first()]
    placed = credits.withColumn("_task", F.spark_partition_id()).repartitionByRange(*order, F.col("_task"))
    placed = scratch_copy(placed.withColumn("_span", F.spark_partition_id()).drop("_task"), "credits")
    return lists(placed, ["title_id", "_span"], billing)


def region_rollup(akas: DataFrame, distinct: bool = False) -> DataFrame:
    """One row per title with known regions: sorted list ``regions`` and ``region_count``.

    ``regions`` repeats a region as often as it occurs (``distinct=True``: once each);
    ``region_count`` counts different regions.

    Occurrences are counted per title and region first, which combines before the shuffle, so
    even a title with a third of all rows sends only one row per region to its list. These rows are
    brought together by title before the lists are made, which are then made once.
    """
    known = F.col("region").isNotNull() & (F.col("region") != NO_REGION)
    per_region = (
        akas.where(known).groupBy("title_id", "region").agg(F.count(F.lit(1)).alias("_n"))
    )
    text = "region" if distinct else "array_join(array_repeat(region, cast(_n as int)), ',')"
    return per_region.repartition("title_id").groupBy("title_id").agg(
        _listed(text, "region").alias("regions"),
        F.count(F.lit(1)).alias("region_count"),
    )
