"""Dense rank and top-N per group, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalog_marts.functions import sort_key
from catalog_marts.sources.writers import scratch_copy


def dense_rank_spread(
    df: DataFrame, group: str, score: str, rank: str = "rank", chunks: int | None = None
) -> DataFrame:
    """Dense rank by ``score`` descending, NULL last, inside ``group``, for groups of any size.

    The same as a window over the group, but every group is spread over many tasks.

    1. Rows are range-partitioned by group and descending score, the reading task's number being
       the last key, so that equal scores can be split too. Each partition is a chunk; its number
       is stored with the rows on shared storage, hence never computed twice.
    2. Per group and chunk: how many different scores, the first and the last one. The running
       sum of those counts says how many different scores come before a chunk. A score on both
       sides of a chunk border must not count twice. This table has at most one row per chunk
       plus one per group.
    3. Rank inside the chunk plus that offset. No task holds more rows than one chunk.

    ``df`` is read twice (finding the ranges takes a first pass) and should be a stored table, or
    at least compute the same scores each time. ``chunks`` fixes the number of chunks; left out,
    adaptive execution sizes them.
    """
    value = F.col(score)
    count = [chunks] if chunks else []
    rows = scratch_copy(
        df.withColumn("_task", F.spark_partition_id())
        .repartitionByRange(*count, F.col(group).asc(), value.desc_nulls_last(), F.col("_task"))
        .withColumn("_chunk", F.spark_partition_id())
        .drop("_task"),
        "dense-rank",
    ).withColumn("_group", F.struct(group))  # as a struct, a NULL group equals itself

    has_null = F.max(value.isNull())
    borders = rows.groupBy("_group", "_chunk").agg(
        (F.count_distinct(value) + has_null.cast("int")).alias("_scores"),
        F.max(value).alias("_first"),
        F.when(~has_null, F.min(value)).alias("_last"),
    )
    by_chunk = Window.partitionBy("_group").orderBy("_chunk")
    continued = F.lag(F.lit(True)).over(by_chunk) & F.lag("_last").over(by_chunk).eqNullSafe(
        F.col("_first")
    )
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        borders.withColumn("_shared", F.coalesce(continued, F.lit(False)).cast("int"))
        .withColumn("_before", F.sum(F.col("_scores") - F.col("_shared")).over(earlier))
        .select(
            "_group",
            "_chunk",
            (F.coalesce("_before", F.lit(0)) - F.col("_shared")).alias("_offset"),
        )
    )

    in_chunk = Window.partitionBy("_group", "_chunk").orderBy(value.desc_nulls_last())
    return (
        rows.withColumn("_in_chunk", F.dense_rank().over(in_chunk))
        .join(offsets, ["_group", "_chunk"])
        .withColumn(rank, (F.col("_in_chunk") + F.col("_offset")).cast("int"))
        .drop("_group", "_chunk", "_in_chunk", "_offset")
    )


def top_n_per_group(
    df: DataFrame,
    group: Sequence[str],
    order_by: Sequence[str],
    n: int,
    rank: str = "rank",
) -> DataFrame:
    """Rows whose dense rank by ``order_by`` inside ``group`` is at most ``n``; ties are kept.

    Ranking needs only the different order values of a group. They are combined before the
    shuffle and Spark drops all but the first ``n`` of a group in each task before the window,
    so a group's task sees a handful of rows however large the group is. The rows are then
    picked by joining on those values, which spreads them; adaptive execution turns that join
    into a broadcast when the winners turn out to be few. ``df`` is read twice, so it should be a
    stored table.
    """
    group, columns = list(group), [key.split(" ")[0] for key in order_by]
    keys = group + columns
    window = Window.partitionBy(*group).orderBy(*[sort_key(k) for k in order_by])
    winners = (
        df.select(*keys)
        .distinct()
        .withColumn(rank, F.dense_rank().over(window))
        .where(F.col(rank) <= n)
        .select(*[F.col(k).alias(f"_{k}") for k in keys], rank)
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return df.join(winners, same).drop(*[f"_{k}" for k in keys])
