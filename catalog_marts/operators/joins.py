"""A left join whose hot keys are spread over many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def left_join_spread(left: DataFrame, key: str, *rights: DataFrame) -> DataFrame:
    """``left`` LEFT JOIN each of ``rights`` on ``key``, exact, even if one key fills ``left``.

    Adaptive execution splits a skewed join by itself when both inputs come straight from a
    shuffle. It cannot where the right side is an aggregate that already lies partitioned by the
    key, and that is the case this join is for.

    The rows of ``left`` are counted per key, an aggregate that combines before the shuffle. The
    right sides are attached to these counts, one row per key, so none of those joins can be
    skewed, and aggregates by ``key`` need no further shuffle. ``left`` itself is then joined
    once. A key with more than a shuffle partition's fair share of the rows is hot and gets as
    many parts as it has shares: its rows take a part number from the task that reads them and
    a hash of the row (the same number if that task runs again), and the attached row is repeated
    once per part. So a key is split inside one reading task, too; only equal rows that one task
    reads stay together. Rows without a key match nothing and are spread the same way.

    With ``n`` shuffle partitions fewer than ``n`` keys can exceed the fair share, which bounds
    the broadcast list of hot keys, and the parts of all of them together are at most ``2 n``.
    ``left`` should be a stored table, as its key column is read a second time.
    """
    shares = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    counts = counts.withColumn("_parts", F.ceil(F.col("_rows") * shares / total)).drop("_rows")

    attached = counts
    for right in rights:
        attached = attached.join(right, key, "left")
    attached = attached.withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    ).drop("_parts")

    hot = F.broadcast(counts.where(F.col("_parts") > 1))
    spread_over = F.when(F.col(key).isNull(), shares).otherwise(F.coalesce("_parts", F.lit(1)))
    hashed = [f.name for f in left.schema if "map<" not in f.dataType.simpleString()]
    number = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{name}`") for name in hashed])
    numbered = (
        left.join(hot, key, "left").withColumn("_part", F.pmod(number, spread_over)).drop("_parts")
    )
    return numbered.join(attached, [key, "_part"], "left").drop("_part")
