"""Bayesian weighted rating and whole-table rating totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_marts.functions import bayes_score

PRIOR_VOTES = 1000.0  # fixed value of the weighting formula


def rating_totals(ratings: DataFrame) -> DataFrame:
    """One row: mean rating over the rated titles (not weighted by votes) and all votes."""
    return ratings.agg(
        F.avg("average_rating").alias("overall_avg"),
        F.sum("num_votes").alias("total_votes"),
    )


def weighted_rating(
    ratings: DataFrame, prior_votes: float = PRIOR_VOTES, mean: float | None = None
) -> DataFrame:
    """Add ``weighted_rating``: v/(v+m)*R + m/(v+m)*C, with C the mean rating of the table.

    C comes from a scalar subquery, i.e. a partial/final aggregate whose single number is put
    into the projection. The rating rows themselves are never shuffled; an unpartitioned window
    would bring all of them into one task. A NULL rating or vote count gives a NULL score and
    stays out of C. ``mean`` is C where ``ratings`` are only a part of the table.
    """
    whole = ratings.agg(F.avg("average_rating")).scalar() if mean is None else F.lit(mean)
    score = bayes_score(F.col("average_rating"), F.col("num_votes"), whole, prior_votes)
    return ratings.select("title_id", "average_rating", "num_votes", score.alias("weighted_rating"))
