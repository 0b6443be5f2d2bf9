"""Rating statistics stored on several levels, and answers from the smallest level that has them.

A level holds, per combination of its dimensions, states that can be merged: how many titles and
ratings there are, the exact sum of the ratings, and the largest number of votes. A level is rolled
up from the smallest one before it that determines its dimensions (a year determines its decade),
so the titles themselves are read once, and by no request.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_marts.sources import read_table, scratch_copy, write_table

#: Dimensions that follow from another one: name -> that one, and the expression.
DERIVED = {"decade": ("start_year", "cast(floor(start_year / 10) * 10 as int)")}
LEVELS = (
    ("start_year", "title_type"), ("decade", "title_type"), ("start_year",), ("title_type",), ("decade",), (),
)

_STATE = {"titles": "bigint", "ratings": "bigint", "rating_sum": "decimal(38,12)", "max_votes": "int"}
_TYPES = {"start_year": "int", "decade": "int", "title_type": "string"}
_INDEX = "level string, dimensions array<string>, rows bigint"


def _merged(rows: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast(_STATE[c]).alias(c)
    return rows.groupBy(*dimensions).agg(total("titles"), total("ratings"), total("rating_sum"), F.max("max_votes").alias("max_votes"))


def _with(rows: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Add derived dimensions that a level does not hold itself."""
    return rows.withColumns({d: F.expr(DERIVED[d][1]) for d in dimensions if d not in rows.columns})


def _covers(held: Sequence[str], wanted: Sequence[str]) -> bool:
    return all(d in held or d in DERIVED and DERIVED[d][0] in held for d in wanted)


def _name(dimensions: Sequence[str]) -> str:
    return "-".join(dimensions) or "all"


def _facts(facts: DataFrame) -> DataFrame:
    """The states of single titles."""
    exact = F.col("average_rating").cast("decimal(20,12)")
    return facts.select(
        F.col("start_year").cast("int").alias("start_year"), "title_type", F.lit(1).cast("bigint").alias("titles"),
        exact.isNotNull().cast("bigint").alias("ratings"), exact.alias("rating_sum"), F.col("num_votes").alias("max_votes"),
    )


def _store(rolled: dict[tuple[str, ...], DataFrame], path: str) -> None:
    entries = []
    for level, rows in rolled.items():
        write_table(rows, f"{path}/{_name(level)}")
        entries.append((_name(level), list(level), rows.count()))
    spark = next(iter(rolled.values())).sparkSession
    write_table(spark.createDataFrame(entries, _INDEX), f"{path}/levels")


def _rolled(states: DataFrame, levels: Sequence[Sequence[str]]) -> dict[tuple[str, ...], DataFrame]:
    """Each level from the smallest of those before it, the first ones from ``states``."""
    done: dict[tuple[str, ...], tuple[DataFrame, int]] = {}
    for level in map(tuple, levels):
        sources = [x for held, x in done.items() if _covers(held, level)]
        source = min(sources, key=lambda x: x[1])[0] if sources else states
        rows = scratch_copy(_merged(_with(source, level), level), "level")
        done[level] = rows, rows.count()
    return {level: rows for level, (rows, _) in done.items()}


def build_lattice(facts: DataFrame, path: str, levels: Sequence[Sequence[str]] = LEVELS) -> None:
    """Store the levels of ``facts`` (``start_year``, ``title_type``, ``average_rating``,
    ``num_votes``; a row per title) below ``path``. NULL dimensions are groups like others.
    """
    _store(_rolled(_facts(facts), levels), path)


def _levels(spark: SparkSession, path: str) -> list[tuple[tuple[str, ...], int]]:
    rows = read_table(spark, f"{path}/levels", _INDEX).collect()  # one per level
    return [(tuple(r["dimensions"]), r["rows"]) for r in rows]


def _open(spark: SparkSession, path: str, level: Sequence[str]) -> DataFrame:
    schema = ", ".join(f"{d} {_TYPES[d]}" for d in level) + ", " * bool(level) + ", ".join(f"{c} {t}" for c, t in _STATE.items())
    return read_table(spark, f"{path}/{_name(level)}", schema)


def merge_lattice(path: str, facts: DataFrame) -> None:
    """Add titles to the levels below ``path``: states of old and new titles are merged, level by
    level, without reading the old titles.
    """
    spark = facts.sparkSession
    levels = [level for level, _ in _levels(spark, path)]
    more = _rolled(_facts(facts), levels)
    both = {level: scratch_copy(_merged(_open(spark, path, level).unionByName(rows), level), "level") for level, rows in more.items()}
    _store(both, path)


def chosen_level(spark: SparkSession, path: str, wanted: Sequence[str]) -> tuple[str, ...]:
    """The level with the fewest rows that determines all the dimensions."""
    fitting = [(rows, level) for level, rows in _levels(spark, path) if _covers(level, wanted)]
    if not fitting:
        raise ValueError(f"no level has {', '.join(wanted)}")
    return min(fitting)[1]


def rating_statistics(
    spark: SparkSession,
    path: str,
    by: Sequence[str] = (),
    between: Mapping[str, tuple[Any, Any]] | None = None,
    equal: Mapping[str, Any] | None = None,
    decimals: int | None = 2,
) -> DataFrame:
    """``total_titles``, ``avg_rating`` and ``max_votes`` by some dimensions, from the stored levels.

    ``between`` and ``equal`` restrict dimensions, which need not be grouped by; bounds are
    inclusive and NULL is outside of them. The mean is that of the ratings, NULL without any.
    Only the chosen level is read.
    """
    between, equal = dict(between or {}), dict(equal or {})
    wanted = list(dict.fromkeys([*by, *between, *equal]))
    rows = _with(_open(spark, path, chosen_level(spark, path, wanted)), wanted)
    for dimension, (low, high) in between.items():
        rows = rows.where(F.col(dimension).between(low, high))
    for dimension, value in equal.items():
        rows = rows.where(F.col(dimension) == value)
    mean = F.try_divide(F.col("rating_sum").cast("double"), F.col("ratings"))
    mean = mean if decimals is None else F.round(mean, decimals)
    merged = _merged(rows, by)
    if not by:  # a request without rows has no group, as with any other grouping
        merged = merged.where("titles > 0")
    return merged.select(*by, F.col("titles").alias("total_titles"), mean.alias("avg_rating"), "max_votes")
