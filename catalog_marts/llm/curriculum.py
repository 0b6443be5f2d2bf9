"""Mixing sources to target weights along a time-varying curriculum, in DataFrame expressions only.

Every source has a weight that changes over training time. Its share of the training stream up to
a time is the integral of the weight so far, so the words that it has to deliver up to then, its
cumulative demand, is that integral scaled to the source's target. The texts of a source stand in
a fixed random order and are read again from the start when used up; each one is needed at the
time at which the demand reaches the words before it. That time, its position, puts the texts of
all sources in one order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalog_marts.llm.text import WORD
from catalog_marts.sources import scratch_copy

#: Weight of a source over time 0 to 1, as a factor of its share: (time, factor), straight lines
#: between. By rank of the source modulo their number: falling, rising, highest in the middle.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 0.5), (1.0, 1.5)),
    ((0.0, 0.5), (0.5, 1.5), (1.0, 0.5)),
)
WEIGHTS = (1, 2, 3)  # by rank of the source, repeating
MAX_REPEATS = 3  # no text is used more often
BUCKETS = 4096  # hash ranges that a source's running sum is computed in


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """``source``, ``source_size``, ``source_rank`` and ``target`` from ``source`` and ``size``.

    Sources rank by code point, null last. All sizes together are shared by weight; a source
    stops at ``max_repeats`` times its own size, and the rest is shared again by weight. Ordered
    by what a unit of weight can take, the sources that stop come first, so two running sums
    give the level that the others share, the one of the first source that doesn't stop. The
    windows hold one row per source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = by_source.withColumn(
        "source_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("_w", weight.cast("bigint"))
    ranked = ranked.withColumn("_cap", F.col("source_size") * max_repeats)
    before = Window.orderBy((F.col("_cap") / F.col("_w")), "source_rank").rowsBetween(
        Window.unboundedPreceding, -1
    )
    rest = Window.orderBy((F.col("_cap") / F.col("_w")), "source_rank").rowsBetween(
        0, Window.unboundedFollowing
    )
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    ) / F.sum("_w").over(rest)
    levelled = ranked.withColumn("_level", level).withColumn("_stops", F.col("_cap") <= F.col("_level") * F.col("_w"))
    shared = F.max(F.when(~F.col("_stops"), F.col("_level"))).over(everything)
    target = F.when(F.col("_stops"), F.col("_cap").cast("double")).otherwise(shared * F.col("_w"))
    return levelled.select("source", "source_size", "source_rank", target.alias("target"))


def _position(demand: Column, schedules) -> Column:
    """The time at which a share ``demand`` (0 to 1) of a source's words has been asked for."""

    def inverse(schedule):
        area = [0.0]
        for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
            area.append(area[-1] + (t1 - t0) * (w0 + w1) / 2)
        at = demand * area[-1]
        found = F.lit(float(schedule[-1][0]))
        for k in reversed(range(len(schedule) - 1)):
            (t0, w0), (t1, w1) = schedule[k], schedule[k + 1]
            slope = (w1 - w0) / (t1 - t0)
            left = at - area[k]  # w0 * x + slope / 2 * x ** 2 = left
            x = 2 * left / (w0 + F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * left, F.lit(0.0))))
            found = F.when(at < area[k + 1], F.lit(t0) + x).otherwise(found)
        return found

    chosen = F.lit(None).cast("double")
    for k, schedule in enumerate(schedules):
        chosen = F.when(F.col("source_rank") % len(schedules) == k, inverse(schedule)).otherwise(chosen)
    return chosen


def mix_sources(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    schedules=SCHEDULES,
    whole: bool = False,
    buckets: int = BUCKETS,
) -> DataFrame:
    """How many words of each text the mix takes, and when.

    Returns ``doc_id`` (the key), ``size`` (words of the text), ``source``, ``source_size``,
    ``target``, ``taken`` (words that the mix takes, repeats counted) and ``positions``, an array
    with the time of each use, of which the last may take only the first words of a text. With
    ``whole`` a use that would take less than half of a text is left out and one that takes more
    is made a whole one, so each source misses its target by half a text at most; without it the
    words taken are the target, rounded.

    The order within a source is by MD5 of the key. A source may hold most rows: sums run within
    ``buckets`` ranges of the hash and then over the ranges' sums, never over a source in one
    task. Sources are expected to number less than about a million, as their totals are ranked
    in one task.

    A null or empty text has size 0 and is never used (``taken`` 0, no positions); null sources
    form one source that ranks last; repeated keys and rows count one by one (those that agree in
    key and size are interchangeable); a null key is kept and sorts first; an empty table gives an
    empty table; columns other than the three named are ignored.

    Sizes are counted by a job that runs when this is called; the rest is lazy.
    """
    digits = ((buckets - 1).bit_length() + 3) // 4
    order = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("_source"),  # never null
        word_count(F.col(text)).alias("size"),
        order.alias("_order"),
        F.substring(order, 1, digits).alias("_bucket"),
    )
    rows = scratch_copy(rows, "sizes")  # the texts are read once

    sums = rows.groupBy("_source", "_bucket").agg(
        F.first("source").alias("source"), F.sum("size").alias("size")
    )
    targets = source_targets(sums, weights, max_repeats)
    targets = targets.withColumn("_source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    earlier = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_source", "_bucket", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("_start"))
    starts = starts.join(targets.drop("source"), "_source")

    inside = Window.partitionBy("_source", "_bucket").orderBy("_order", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = rows.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(starts, ["_source", "_bucket"])
    placed = placed.withColumn("_before", F.col("_start") + F.col("_inside"))

    wanted = F.round("target").cast("bigint")
    uses, taken = [], F.lit(0).cast("bigint")
    for k in range(max_repeats):
        begin = F.col("_before") + k * F.col("source_size")
        words = F.greatest(F.least(wanted - begin, F.col("size")), F.lit(0).cast("bigint"))
        if whole:
            words = F.when(2 * words >= F.col("size"), F.col("size")).otherwise(F.lit(0).cast("bigint"))
        at = _position(F.least(begin / F.col("target"), F.lit(1.0)), schedules)
        uses.append(F.when(words > 0, at))
        taken = taken + words
    return placed.select(
        "doc_id", "size", "source", "source_size", "target", taken.alias("taken"),
        F.array_compact(F.array(*uses)).alias("positions"),
    )


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per use of a text (``doc_id``, ``position``), range-sorted by position."""
    uses = mixed.select("doc_id", F.explode("positions").alias("position"))
    return uses.orderBy("position", "doc_id")
