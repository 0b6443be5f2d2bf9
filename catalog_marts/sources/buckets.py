"""Bucketed tables: joins and aggregates on the bucket key need no shuffle.

Two tables bucketed alike on a key are joined bucket by bucket. One task reads a whole bucket and
adaptive execution cannot split it. Where :func:`bucket_sizes` shows a dominating bucket, open the
table with ``bucketed=False``: the same files are then read as plain Parquet, and the join
shuffles and splits as usual.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def bucket_sizes(df: DataFrame, keys: Sequence[str], n_buckets: int) -> DataFrame:
    """Rows per bucket (``bucket``, ``rows``), for the caller's choice; reads the keys only."""
    bucket = F.pmod(F.hash(*keys), F.lit(n_buckets)).alias("bucket")
    return df.groupBy(bucket).agg(F.count(F.lit(1)).alias("rows"))


def write_bucketed(
    df: DataFrame, table: str, path: str, keys: Sequence[str], n_buckets: int, bucketed: bool = True
) -> DataFrame:
    """Store ``df`` at ``path`` in buckets sorted by ``keys``, as external table ``table``.

    The rebalance sends each bucket to one task, hence one file, unless the bucket is so large
    that adaptive execution splits it. Returns what :func:`open_bucketed` returns.
    """
    keys = list(keys)
    (
        df.withColumn("_bucket", F.pmod(F.hash(*keys), F.lit(n_buckets)))
        .hint("rebalance", "_bucket")
        .drop("_bucket")
        .write.mode("overwrite")
        .bucketBy(n_buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(table)
    )
    columns = ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)
    return open_bucketed(df.sparkSession, table, path, columns, keys, n_buckets, bucketed)


def open_bucketed(
    spark: SparkSession,
    table: str,
    path: str,
    schema: str,
    keys: Sequence[str],
    n_buckets: int,
    bucketed: bool = True,
) -> DataFrame:
    """The bucketed table stored at ``path``, put into the session's catalog if it is not there.

    With ``bucketed=False`` the frame returned reads the same files without their buckets.
    """
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"create table if not exists {table} ({schema}) using parquet "
        f"clustered by ({by}) sorted by ({by}) into {int(n_buckets)} buckets location '{path}'"
    )
    return spark.table(table) if bucketed else spark.read.schema(schema).parquet(path)
