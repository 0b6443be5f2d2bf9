"""Parquet sinks, and scratch tables in the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from catalog_marts.functions import non_blank, sort_key

from .curve import curve_position
from .folders import remove_folder

SLICES = 48  # at least, of a sorted table with a given number of files
MOST_SLICES = 16  # of one of its files


def _as_list(value) -> list:
    if value is None:
        return []
    return list(value) if isinstance(value, (list, tuple)) else [value]


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | Sequence[str] | None = None,
    sort_by: str | Sequence[str] | None = None,
    n_files: int | None = None,
    max_records_per_file: int = 0,
    cluster: str = "range",
    observed: Observation | None = None,
    only_partitions: bool = False,
) -> None:
    """Replace the Parquet table at ``path``; the layout follows the arguments.

    ``sort_by`` alone
        Rows are range-partitioned on the sort key and sorted inside each task, so files hold
        disjoint key ranges and a reader can skip them by their min/max. The writing task's
        number is the last range key: it lets copies of one row, or a single hot key, be spread
        over several files. It is stable when a lost task is run again, which a random number
        would not be. Finding the ranges costs a first pass over the input; ``cluster="hash"``
        does without: rows of one value of the first key still lie together, sorted, in files
        of even size, but every file covers the whole key range. ``cluster="curve"`` sorts by
        :func:`curve_position` instead, so that files cover small ranges of every key, and filters
        on the second or third skip files, too; keys are ascending then.
    ``partition_by``
        A rebalance by the partition columns: adaptive execution splits an oversized partition
        value over several tasks and packs small ones together. The local sort leads with the
        partition columns, because the writer would otherwise sort again by them and lose the
        requested order. NULL or blank text in a partition column becomes ``unknown``.
    neither
        Plain write.

    ``n_files`` fixes the number of writing tasks; left out, adaptive execution sizes them. A few
    files of a large sorted table would leave a few tasks to sort it: its ranges are then cut into
    more slices than files, sorted and stored slice by slice in the scratch folder, and a writing
    task only strings the slices of its file together.
    ``observed`` counts the ``rows`` written. With ``only_partitions`` the partitions that ``df`` has
    rows of are replaced, the others keep their files. Never write to a path that ``df`` itself reads.
    """
    if cluster not in ("range", "hash", "curve"):
        raise ValueError(f"unknown cluster {cluster!r}")
    parts, order = _as_list(partition_by), _as_list(sort_by)
    if cluster == "curve":
        if parts or any(" " in k.strip() for k in order):
            raise ValueError("a curve takes ascending keys and no partition columns")
        df, order = df.withColumn("_curve", curve_position(df, order)), ["_curve", *order]
    keys, in_slices = [sort_key(k) for k in order], False
    count = [n_files] if n_files else []
    types = dict(df.dtypes)
    text_parts = [p for p in parts if types[p] == "string"]
    if text_parts:
        df = df.withColumns({p: non_blank(F.col(p), "unknown") for p in text_parts})

    if parts:
        df = df.hint("rebalance", *count, *[F.col(p) for p in parts])
        df = df.sortWithinPartitions(*parts, *keys)
    elif keys and cluster == "hash":
        df = df.hint("rebalance", *count, order[0].split(" ")[0]).sortWithinPartitions(*keys)
    elif keys:
        slices = _slices_per_file(df.sparkSession, n_files) if n_files else 1
        df = (
            df.withColumn("_task", F.spark_partition_id())
            .repartitionByRange(*[n * slices for n in count], *keys, F.col("_task"))
            .drop("_task")
        )
        in_slices = slices > 1
        if not in_slices:
            df = df.sortWithinPartitions(*keys).drop("_curve")
    elif count:
        df = df.repartition(n_files)

    with scratch_scope(df.sparkSession, "sink") if in_slices else nullcontext():
        if in_slices:
            df = _strung(df, keys, n_files).drop("_curve")
        if observed:
            df = df.observe(observed, F.count(F.lit(1)).alias("rows"))
        writer = df.write.mode("overwrite")
        if max_records_per_file:
            writer = writer.option("maxRecordsPerFile", max_records_per_file)
        if parts:
            writer = writer.partitionBy(*parts)
        if only_partitions:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.parquet(path)


def _slices_per_file(spark: SparkSession, n_files: int) -> int:
    shares = max(int(spark.conf.get("spark.sql.shuffle.partitions")), SLICES)
    return min(-(-shares // n_files), MOST_SLICES)


def _strung(ranges: DataFrame, keys: Sequence[Column], n_files: int) -> DataFrame:
    """Range partitions as ``n_files`` sorted ones of about as many rows, without sorting them there.

    Every range is sorted and stored as a file of its own, and ``coalesce(1)`` reads files one after
    the other. (Over the sorts themselves it would run them all in the writing task.) The empty frame
    keeps the union from putting single partitions into one.
    """
    spark, schema = ranges.sparkSession, ranges.schema
    path = scratch_dir(spark, "slices")
    numbered = ranges.withColumn("_slice", F.spark_partition_id()).sortWithinPartitions("_slice", *keys)
    numbered.write.partitionBy("_slice").parquet(path)
    stored = spark.read.schema(numbered.schema).parquet(path).groupBy("_slice").agg(F.count(F.lit(1)).alias("rows"))
    found = sorted(tuple(row) for row in stored.collect())  # one row per slice
    total, before = sum(rows for _, rows in found), 0
    of_file: dict[int, list[DataFrame]] = {}
    for number, rows in found:
        slice_ = spark.read.schema(schema).parquet(f"{path}/_slice={number}")
        of_file.setdefault((2 * before + rows) * n_files // (2 * total), []).append(slice_)
        before += rows
    empty = spark.createDataFrame(spark.sparkContext.emptyRDD(), schema)
    return reduce(DataFrame.union, [reduce(DataFrame.union, of).coalesce(1) for of in of_file.values()], empty)


_local_folders: dict[str, str] = {}  # application id -> folder, local sessions only


def _scratch_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _local_folders:
            folder = tempfile.mkdtemp(prefix="catalog-marts-")
            _local_folders[context.applicationId] = folder
        shared = _local_folders[context.applicationId]
    return f"{shared.rstrip('/')}/{context.applicationId}"


_scope: ContextVar[str | None] = ContextVar("scratch folder of the running job", default=None)


@contextmanager
def scratch_scope(spark: SparkSession, label: str = "job") -> Iterator[str]:
    """Scratch tables made inside belong to this job and are removed when it ends, also by failure.

    Those of other jobs stay. Results must be stored elsewhere before the scope ends.
    """
    folder = f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)
        remove_folder(spark, folder)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder set in ``spark.checkpoint.dir``.

    Only a local session may do without the setting. The folder lies in the running job's
    :func:`scratch_scope`, or outside of one in the application's own folder, where it stays for
    as long as the caller wants it: a lazy result may still read it.
    """
    return f"{_scope.get() or _scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def scratch_copy(df: DataFrame, label: str) -> DataFrame:
    """Store ``df`` once and read it back, so later steps see exactly these rows.

    The copy is an ordinary Parquet table on shared storage: it outlives lost executors, cuts
    the lineage, and each reader fetches only the columns it needs.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
