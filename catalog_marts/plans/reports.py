"""The four reports. Each returns a DataFrame; defaults are the published parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_marts.functions import contains_any
from catalog_marts.operators import top_n_per_group

# Report parameters.
FIRST_YEAR, LAST_YEAR = 1980, 2025
MOVIE = "movie"
HIGH_RATING, MANY_VOTES, REPORT_ROWS = 8.5, 100000, 100
SEARCH_TERMS = ("star wars", "lord of the rings")
YEARLY_VOTES, YEARLY_TOP = 50000, 3

TITLE_COLUMNS = ("title_id", "primary_title", "start_year", "average_rating", "num_votes")


def _mean(col: str, decimals: int | None) -> Column:
    mean = F.avg(col)
    return mean if decimals is None else F.round(mean, decimals)


def _capped(df: DataFrame, max_rows: int | None) -> DataFrame:
    return df if max_rows is None else df.limit(max_rows)


def report_q1(
    titles: DataFrame,
    ratings: DataFrame,
    first_year: int = FIRST_YEAR,
    last_year: int = LAST_YEAR,
    decimals: int | None = 2,
    max_rows: int | None = None,
) -> DataFrame:
    """Rated titles per year and type: count, mean rating, highest vote count.

    The year range reaches the title scan. Both join inputs are plain scans, so adaptive
    execution can split a skewed title; the aggregate combines before its small shuffle.
    ``decimals=None`` returns the unrounded mean, ``max_rows`` caps the report.
    """
    in_range = F.col("start_year").isNotNull() & F.col("start_year").between(first_year, last_year)
    report = (
        titles.where(in_range)
        .select("title_id", "start_year", "title_type")
        .join(ratings.select("title_id", "average_rating", "num_votes"), "title_id")
        .groupBy("start_year", "title_type")
        .agg(
            F.count(F.lit(1)).alias("total_titles"),
            _mean("average_rating", decimals).alias("avg_rating"),
            F.max("num_votes").alias("max_votes"),
        )
        .orderBy(F.desc("start_year"), F.desc("total_titles"), "title_type")
    )
    return _capped(report, max_rows)


def report_q2(
    mart: DataFrame,
    title_type: str = MOVIE,
    min_rating: float = HIGH_RATING,
    min_votes: int = MANY_VOTES,
    k: int = REPORT_ROWS,
) -> DataFrame:
    """The ``k`` best rated titles of a type among those with many votes.

    The type prunes partitions of the stored mart, the ranges are pushed into the scan, the
    genre copies of a title fold together before the shuffle, and sort plus limit becomes a
    per-task top-k. ``title_id`` settles ties. The rating bound is compared as a float, the type
    of the column, so 4.7 includes a stored 4.7.
    """
    return (
        mart.where(
            (F.col("title_type") == title_type)
            & (F.col("average_rating") >= F.lit(min_rating).cast("float"))
            & (F.col("num_votes") >= min_votes)
        )
        .select(*TITLE_COLUMNS)
        .distinct()
        .orderBy(F.desc("average_rating"), F.desc("num_votes"), "title_id")
        .limit(k)
    )


def report_q3(
    mart: DataFrame,
    terms: Sequence[str] = SEARCH_TERMS,
    decimals: int | None = 2,
    grain: str = "row",
    max_rows: int | None = None,
) -> DataFrame:
    """Titles whose name contains one of ``terms``: number and mean rating per type.

    With ``grain="row"`` the mean runs over mart rows, so a title weighs as much as it has
    genres; ``grain="title"`` counts each title once.
    """
    if grain not in ("row", "title"):
        raise ValueError(f"unknown grain {grain!r}")
    found = mart.where(contains_any(F.col("primary_title"), terms)).select(
        "title_type", "title_id", "average_rating"
    )
    if grain == "title":
        found = found.distinct()
    report = found.groupBy("title_type").agg(
        F.count_distinct("title_id").alias("match_count"),
        _mean("average_rating", decimals).alias("avg_rating"),
    )
    if max_rows is not None:  # a cap needs an order: the most matches first
        report = report.orderBy(F.desc("match_count"), "title_type")
    return _capped(report, max_rows)


def report_q4(
    mart: DataFrame,
    title_type: str = MOVIE,
    min_votes: int = YEARLY_VOTES,
    n: int = YEARLY_TOP,
    keep_id: bool = False,
    max_rows: int | None = None,
) -> DataFrame:
    """The ``n`` best ranks per year by rating, then votes; ties share a rank.

    ``keep_id`` adds ``title_id``, which tells titles of the same name apart.
    """
    titles = mart.where(
        (F.col("title_type") == title_type) & (F.col("num_votes") > min_votes)
    ).select(*TITLE_COLUMNS)
    best = top_n_per_group(
        titles, ["start_year"], ["average_rating desc", "num_votes desc"], n, "rank_in_year"
    ).distinct()
    report = best.orderBy(F.desc("start_year"), "rank_in_year", "title_id")
    return _capped(report if keep_id else report.drop("title_id"), max_rows)
