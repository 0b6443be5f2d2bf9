"""The two denormalised marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_marts.operators import (
    crew_rollup,
    dense_rank_spread,
    explode_category,
    left_join_spread,
    region_rollup,
    top_n_per_group,
    weighted_rating,
)
from catalog_marts.sources import scratch_copy

# Averages are sums in no fixed order; rounding keeps equal scores equal when they are ranked.
SCORE_DECIMALS = 9

FACT_COLUMNS = ("average_rating", "num_votes", "weighted_rating", "actors", "directors",
                "producers", "regions", "region_count")


def category_mart(
    titles: DataFrame,
    ratings: DataFrame,
    principals: DataFrame,
    names: DataFrame,
    akas: DataFrame,
    mean: float | None = None,
) -> DataFrame:
    """One row per title and genre with rating, crew lists and release regions.

    ``ratings`` are plain ratings; the weighted rating is computed here, with ``mean`` where they
    are only a part of the table. The rollups already lie
    partitioned by title and are put side by side there; the titles join the result once.
    """
    joined = left_join_spread(
        titles,
        "title_id",
        weighted_rating(ratings, mean=mean),
        crew_rollup(principals, names),
        region_rollup(akas),
    )
    return explode_category(joined.select(*titles.columns, *FACT_COLUMNS), "genres")


def cast_mart(
    principals: DataFrame,
    ratings: DataFrame,
    names: DataFrame,
    person_columns: Sequence[str] = ("primary_name", "birth_year", "death_year"),
    min_titles: int = 0,
    top_n: int | None = None,
) -> DataFrame:
    """Person x category with mean weighted rating, rated credits and dense rank in the category.

    Calling this runs two jobs, which store the averages and the ranked chunks in scratch tables;
    give it a ``scratch_scope`` that lasts until the result is stored. The mean is stored in full
    and ranked by its first nine decimals. ``total_movies`` counts rated credits of every title type. Unrated people have a NULL mean
    and share the last rank. ``min_titles`` drops people with fewer rated credits before
    ranking; ``top_n`` keeps the first ranks only. Both are off by default.

    Credits are summed per person and category before the names are joined: sums combine before
    the shuffle, so neither a busy person nor a common category gathers in one task, and the
    names meet a much smaller table. Identical name rows are counted once up front and that
    count multiplied in, which is what joining them one by one would add up to.
    """
    person_columns = list(person_columns)
    scores = weighted_rating(ratings).select("title_id", "weighted_rating")
    credits = (
        principals.select("title_id", "name_id", "category")
        .join(scores, "title_id", "left")
        .groupBy("name_id", "category")
        .agg(
            F.avg("weighted_rating").alias("avg_weighted_rating"),
            F.count("weighted_rating").alias("_credits"),
        )
    )
    people = names.groupBy("name_id", *person_columns).agg(F.count(F.lit(1)).alias("_copies"))
    cast = credits.join(people, "name_id", "left").select(
        "name_id",
        *person_columns,
        "category",
        "avg_weighted_rating",
        F.round("avg_weighted_rating", SCORE_DECIMALS).alias("_score"),
        (F.col("_credits") * F.coalesce("_copies", F.lit(1))).alias("total_movies"),
    )
    if min_titles:
        cast = cast.where(F.col("total_movies") >= min_titles)
    # Ranking reads its input twice. Stored, a mean also keeps its last digit when a lost task
    # runs again, so no person can change places between two attempts.
    stored = scratch_copy(cast, "cast")
    if top_n is not None:
        return top_n_per_group(stored, ["category"], ["_score desc"], top_n).drop("_score")
    return dense_rank_spread(stored, "category", "_score").drop("_score")
