"""Versions of a published table, of which only the changed partitions are written.

A version is a list of partition folders, its manifest. Every partition has a fingerprint that does
not depend on the order of its rows: their number, and two sums of 64-bit hashes. A partition whose
fingerprint is that of the current version keeps its folder, the others get new ones. Below the
table's folder lie::

    claims/<n>        empty file, created first, so no two publishers write the same version
    data-<n>/...      partition folders that version n wrote
    versions/<n>/     manifest; a version counts from the moment at which this is complete
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from decimal import Decimal
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog_marts.functions import non_blank
from catalog_marts.sources import claim, names_in, remove_folder, scratch_copy, write_table

BUCKETS = 32  # of a table without partition columns
KEEP = 2  # versions that stay readable
DECIMALS = 9  # by which doubles are compared: sums in no fixed order differ in the last digits

MANIFEST = "part string, folder string, rows bigint, sum_a decimal(20,0), sum_b decimal(20,0)"
_BUCKET, _WRAP = "_bucket", Decimal(2**64)
_MARKS = ["rows", "sum_a", "sum_b"]

PIECE_BITS = 22  # hashes are summed in three pieces as whole numbers: 2**41 rows fit, decimals would be slow
SUMS = ["_rows", "_a0", "_a1", "_a2", "_b0", "_b1", "_b2"]


def hash_sums(df: DataFrame, *by: Column, schema: T.StructType | None = None) -> DataFrame:
    """:data:`SUMS` of every group: its rows, and two sums of their hashes in pieces; equal for equal
    rows in any order.

    The columns of ``schema`` count (all, if left out), in the order of their names; NULLs are
    hashed as such, doubles by their first nine decimals. Combines before the shuffle.
    """
    values = []
    for field in sorted(schema or df.schema, key=lambda f: f.name):
        value = F.col(f"`{field.name}`")
        values += [value.isNull(), F.round(value, DECIMALS) if isinstance(field.dataType, T.DoubleType) else value]
    hashed = df.select(*by, F.xxhash64(*values).alias("_a"), F.xxhash64(F.lit("b"), *values).alias("_b"))
    sums = [F.count(F.lit(1)).alias("_rows")]
    for mark in ("a", "b"):
        for i in range(3):
            piece = F.shiftrightunsigned(f"_{mark}", i * PIECE_BITS).bitwiseAND(F.lit((1 << PIECE_BITS) - 1))
            sums.append(F.sum(piece).alias(f"_{mark}{i}"))
    return hashed.groupBy(*[F.col(f"`{c}`") for c in hashed.columns[:-2]]).agg(*sums)


def _marks(sums: DataFrame, by: Column, *others: Column) -> DataFrame:
    """Sums of smaller groups as fingerprints of larger ones."""
    wrapped = lambda x: F.pmod(x, F.lit(_WRAP)).cast("decimal(20,0)")
    exact = lambda c, i: F.sum(c).cast("decimal(24,0)") * F.lit(Decimal(1 << (i * PIECE_BITS))).cast("decimal(14,0)")
    total = lambda mark: sum((wrapped(exact(f"_{mark}{i}", i)) for i in range(1, 3)), wrapped(exact(f"_{mark}0", 0)))
    marks = [F.sum("_rows").alias("rows"), wrapped(total("a")).alias("sum_a"), wrapped(total("b")).alias("sum_b")]
    return sums.groupBy(by).agg(*marks, *others)


def fingerprints(df: DataFrame, by: Column, schema: T.StructType | None = None) -> DataFrame:
    """``rows``, ``sum_a`` and ``sum_b`` of every group: :func:`hash_sums`, put together modulo 2**64."""
    sums = hash_sums(df, by, schema=schema)
    return _marks(sums, F.col(f"`{sums.columns[0]}`"))


def _split(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str], buckets: int) -> tuple[DataFrame, list[str]]:
    """The rows as they will be stored, with the columns that they are partitioned by."""
    if partition_by:
        types = dict(df.dtypes)
        texts = {p: non_blank(F.col(p), "unknown") for p in partition_by if types[p] == "string"}
        return df.withColumns(texts) if texts else df, list(partition_by)
    key = [k.split(" ")[0] for k in sort_by][:1] or df.columns
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in key]), F.lit(buckets)).cast("int")
    return df.withColumn(_BUCKET, bucket), [_BUCKET]


def _label(parts: Sequence[str], buckets: int) -> Column:
    """The partition of a row as text; another number of buckets makes other partitions."""
    of = [F.lit(buckets).alias("_of")] if list(parts) == [_BUCKET] else []
    return F.to_json(F.struct(*[F.col(f"`{p}`") for p in parts], *of)).alias("part")


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions of the table in folder ``root``, oldest first."""
    return [int(n) for n in names_in(spark, f"{root}/versions") if "_SUCCESS" in names_in(spark, f"{root}/versions/{n}")]


def _manifest(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{root}/versions/{version:010d}")


def _next(spark: SparkSession, root: str) -> int:
    number = max(map(int, names_in(spark, f"{root}/claims")), default=0) + 1
    while not claim(spark, f"{root}/claims/{number:010d}"):
        number += 1
    return number


def publish_changes(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    keep: int = KEEP,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Publish ``df`` as the next version of the table in folder ``root``.

    Returns ``part``, ``action`` and ``rows`` of every partition: ``written``, ``kept`` from an
    earlier version, or ``removed`` (with the rows it had). Without ``partition_by`` the table is
    split into hash buckets of its first sort key.

    What was written is read back and its fingerprints compared before the version counts; if they
    differ, or anything fails, the folder goes and the current version stays. Readers see one
    version or the other, never a mixture. Afterwards the newest ``keep`` versions stay readable;
    folders that none of them lists are removed, and so are those that an earlier failed or
    overtaken publisher left. A publisher that is overtaken by a later version gives up with an
    error. With ``keep`` = 1, a publisher may remove folders that another one at work still needs;
    that one fails and the table stays whole.

    ``df`` is read twice and should be stored. The driver sees one row per partition, and only
    when a table is opened or cleaned up.
    """
    spark = df.sparkSession
    stored, parts = _split(df, list(partition_by), list(sort_by), buckets)
    number = _next(spark, root)
    data, manifest = f"{root}/data-{number:010d}", f"{root}/versions/{number:010d}"
    earlier = versions(spark, root)
    now = _marks(hash_sums(stored, *[F.col(f"`{p}`") for p in parts]), _label(parts, buckets))
    empty = spark.createDataFrame([], MANIFEST)
    before = _manifest(spark, root, earlier[-1]).where("part is not null") if earlier else empty
    before = before.select("part", *[F.col(c).alias(f"old_{c}") for c in (*_MARKS, "folder")])
    if earlier and _contents(spark, root, earlier[-1])[1].simpleString() != stored.schema.simpleString():
        before = before.withColumn("old_sum_a", F.lit(None).cast("decimal(20,0)"))  # nothing can stay
    action = F.when(F.col("rows").isNull(), "removed").when(_same("old"), "kept").otherwise("written")
    try:
        plan = scratch_copy(now.join(before, "part", "full").withColumn("action", action), "publish")
        written = plan.where("action = 'written'")
        folders = empty
        if not written.isEmpty():
            fresh = stored
            if not plan.where("action = 'kept'").isEmpty():
                fresh = stored.withColumn("_part", _label(parts, buckets))
                fresh = fresh.join(written.select(F.col("part").alias("_part")), "_part", "left_semi").drop("_part")
            write_table(fresh, data, parts, list(sort_by) or None)
            folders = scratch_copy(_arrived(spark, data, stored.schema, parts, buckets), "arrived")
            arrived = folders.select("part", *[F.col(c).alias(f"new_{c}") for c in _MARKS])
            if not written.join(arrived, "part", "full").where(~_same("new")).isEmpty():
                raise RuntimeError(f"what was written to {data} is not what was sent")
        if any(v > number for v in versions(spark, root)):
            raise RuntimeError(f"version {number} was overtaken")
        kept = plan.where("action = 'kept'").select("part", F.col("old_folder").alias("folder"), *_MARKS)
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in stored.schema])  # as files read
        head = spark.createDataFrame([(None, schema.json(), 0, None, None)], MANIFEST)
        entries = kept.unionByName(folders.select("part", "folder", *_MARKS)).unionByName(head)
        entries.coalesce(1).write.parquet(manifest)
    except Exception:
        remove_folder(spark, data)
        remove_folder(spark, manifest)
        raise
    _clean_up(spark, root, max(keep, 1))
    return plan.select("part", "action", F.coalesce("rows", "old_rows").alias("rows"))


def _same(other: str) -> Column:
    """Are the marks those of another list? A partition that only one list has differs."""
    same = F.lit(True)
    for mark in _MARKS:
        same &= F.col(mark).eqNullSafe(F.col(f"{other}_{mark}"))
    return same


def _files(spark: SparkSession, data: str, schema: T.StructType, *paths: str) -> DataFrame:
    """Rows of partition folders below the folder ``data``, with the folder of each row."""
    rows = spark.read.schema(schema).option("basePath", data).parquet(*(paths or [data]))
    return rows.select(*[F.col(f"`{c}`") for c in schema.names], _folder_of("_metadata.file_path").alias("_folder"))


def _folder_of(file: str) -> Column:
    return F.regexp_extract(file, "(data-[0-9]+(/[^/]*)*)/[^/]*$", 1)


def _arrived(spark: SparkSession, data: str, schema: T.StructType, parts: Sequence[str], buckets: int) -> DataFrame:
    """Fingerprints and folders of the partitions that a version wrote, from its files, read once."""
    rows = spark.read.schema(schema).option("basePath", data).parquet(data)
    file = F.col("_metadata.file_path").alias("_file")
    sums = hash_sums(rows, *[F.col(f"`{p}`") for p in parts], file, schema=schema)
    return _marks(sums, _label(parts, buckets), F.min(_folder_of("_file")).alias("folder"))


def _contents(spark: SparkSession, root: str, version: int) -> tuple[dict[str, list[str]], T.StructType]:
    """Partition folders of a version by the folder of the version that wrote them, and the schema."""
    rows = _manifest(spark, root, version).select("part", "folder").collect()  # one row per partition
    schema = next(r["folder"] for r in rows if r["part"] is None)
    by_data: dict[str, list[str]] = {}
    for folder in sorted(unquote(r["folder"]) for r in rows if r["part"] is not None):
        by_data.setdefault(folder.split("/")[0], []).append(folder)
    return by_data, T.StructType.fromJson(json.loads(schema))


def _version_files(spark: SparkSession, root: str, version: int) -> DataFrame:
    by_data, schema = _contents(spark, root, version)
    result = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("_folder", T.StringType())]))
    for data, folders in by_data.items():
        result = result.unionByName(_files(spark, f"{root}/{data}", schema, *[f"{root}/{f}" for f in folders]))
    return result


def _current(spark: SparkSession, root: str) -> int:
    found = versions(spark, root)
    if not found:
        raise FileNotFoundError(f"no published version in {root}")
    return found[-1]


def open_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A version of the table in folder ``root``, the current one if left out."""
    return _version_files(spark, root, version or _current(spark, root)).drop("_folder", _BUCKET)


def verify_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Compare the files of a version with its manifest: ``part``, ``rows`` as recorded, ``ok``.

    A partition whose files are gone is not ``ok``; the others are read and hashed again.
    """
    version = version or _current(spark, root)
    _, schema = _contents(spark, root, version)
    found = fingerprints(_version_files(spark, root, version), F.col("_folder"), schema)
    found = found.select(F.col("_folder").alias("folder"), *[F.col(c).alias(f"new_{c}") for c in _MARKS])
    manifest = _manifest(spark, root, version).where("part is not null")
    return manifest.join(found, "folder", "left").select("part", "rows", _same("new").alias("ok"))


def _clean_up(spark: SparkSession, root: str, keep: int) -> None:
    """Remove older versions and the partition folders that none of the others lists.

    Data of versions that are neither complete nor newer than the current one was left by a
    publisher that failed or was overtaken.
    """
    complete = versions(spark, root)
    kept, old = complete[-keep:], complete[:-keep]
    listed = {f for v in kept for folders in _contents(spark, root, v)[0].values() for f in folders}
    in_use = {f.split("/")[0] for f in listed}
    for version in old:
        by_data, _ = _contents(spark, root, version)
        remove_folder(spark, f"{root}/versions/{version:010d}")
        for data, folders in by_data.items():
            for folder in folders if data in in_use else []:
                if folder not in listed:
                    remove_folder(spark, f"{root}/{folder}")
    for data in names_in(spark, root):
        if data.startswith("data-") and data not in in_use and int(data[5:]) < complete[-1]:
            remove_folder(spark, f"{root}/{data}")
