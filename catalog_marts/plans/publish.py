"""Publish tables to a serving location, several at once, and check what arrived."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from catalog_marts.sources import SILVER

from .together import run_together
from .versions import KEEP, open_version, publish_changes

STATUS_SCHEMA = "table string, rows bigint, ok boolean, seconds double, error string"
PARALLELISM = 3  # fixed value: tables written at the same time

# Serving tables, small ones first.
SERVING_TABLES = (
    "silver_ratings",
    "gold_top_category_wise_cast",
    "silver_names",
    "silver_titles",
    "silver_akas",
    "gold_category_wise_movies",
    "silver_principals",
)


#: Partition columns and sort key of each serving table, as in the layers.
LAYOUT: dict[str, tuple] = {
    **{f"silver_{name}": (spec.partition_by, spec.sort_by) for name, spec in SILVER.items()},
    "gold_category_wise_movies": (["title_type", "genres"], "weighted_rating desc"),
    "gold_top_category_wise_cast": ("category", "avg_weighted_rating desc"),
}


def _listed(value: str | Sequence[str] | None) -> list[str]:
    return [value] if isinstance(value, str) else list(value or [])


def _publish_one(df: DataFrame, name: str, target: str, keep: int) -> tuple[int, DataFrame, float]:
    """Publish the next version of a table. Readers keep the earlier one until it is whole, and for
    good if this one fails.
    """
    started = time.monotonic()
    partition_by, sort_by = map(_listed, LAYOUT.get(name, (None, None)))
    parts = publish_changes(df, f"{target}/{name}", partition_by, sort_by, keep)
    rows = parts.where("action <> 'removed'").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    return rows, parts, time.monotonic() - started


def open_published(spark: SparkSession, target: str, name: str, schema: str | None = None) -> DataFrame:
    """The current version of a published table; ``schema`` picks and orders its columns."""
    table = open_version(spark, f"{target}/{name}")
    if schema is None:
        return table
    return table.to(StructType.fromDDL(schema))


def publish(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    target: str,
    parallelism: int = PARALLELISM,
    keep: int = KEEP,
) -> DataFrame:
    """Write each table below ``target/<name>``; return one status row per table.

    The writes are independent Spark jobs, ``parallelism`` of them at a time. A serving table
    keeps its partition folders and sort key. Only partitions that differ from the current version
    are written (:func:`publish_changes`); :func:`open_published` finds the new version once its
    contents have been compared with what was sent. A failing table does not stop the others: its
    row has ``ok = false`` and the error, and its earlier version stays current. ``rows`` are those
    of the new version, ``seconds`` the time it took. The newest ``keep`` versions stay readable.
    """
    jobs = {name: partial(_publish_one, df, name, target, keep) for name, df in tables.items()}
    done, failures = run_together(spark, jobs, parallelism)
    status = []
    for name in tables:
        if name in failures:
            status.append((name, None, False, None, str(failures[name])))
        else:
            rows, _, seconds = done[name]
            status.append((name, rows, True, seconds, None))
    return spark.createDataFrame(status, STATUS_SCHEMA)


def raise_on_failure(status: DataFrame) -> None:
    """Fail when a published table is not complete, naming all of them."""
    failed = [row["table"] for row in status.where(~F.col("ok")).collect()]
    if failed:
        raise RuntimeError("not published: " + ", ".join(failed))
