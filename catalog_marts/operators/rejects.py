r"""Cleaning a dump together with what it could not take in.

The lines of a dump are read once, as text. A value that does not fit its column becomes NULL, as
in :func:`clean_table`, and is reported with file, line, column, raw text and reason; so is a line
with too few or too many fields. Line numbers come from the splits in which the file was read: each
split numbers its own lines, and the lines of the splits before it are added.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalog_marts.functions import lenient_cast, strip_chars
from catalog_marts.sources import TableSpec, scratch_copy

FIELDS = "fields"  # the column named in the report of a line with another number of fields


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the split that they are in, and a number that grows inside a split."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_at"),
    )


def _header(spark: SparkSession, path: str) -> str:
    first = _lines(spark, path).where("_split = 0").limit(1).select("value").first()
    if first is None:
        raise ValueError(f"no lines in {path}")
    return first[0]


def _reason(type_name: str) -> str:
    return f"no {type_name}"


def _parsed(lines: DataFrame, spec: TableSpec, names: Sequence[str]) -> DataFrame:
    """Cleaned columns, and ``_bad``: what was wrong with a line, NULL if nothing was."""
    fields = F.split(F.col("value"), "\t", -1)
    missing = [f.raw for f in spec.fields if f.raw not in names]
    if missing:
        raise ValueError(f"no column {missing[0]} in the header")

    def raw_value(name: str) -> Column:
        text = F.get(F.col("_fields"), F.lit(names.index(name)))
        return F.when(~text.isin("\\N", ""), text)

    cleaned, bad = [], []
    found = F.size("_fields")
    wrong = F.concat(F.lit("found "), found.cast("string"), F.lit(f" of {len(names)} fields"))
    report = lambda column, text, reason: F.struct(F.lit(column).alias("column"), text.alias("raw"), reason.alias("reason"))
    bad.append(F.when(found != len(names), report(FIELDS, F.col("value"), wrong)))
    for field in spec.fields:
        raw = raw_value(field.raw)
        value = lenient_cast(raw, field.type)
        if field.type != "string":
            bad.append(F.when(raw.isNotNull() & value.isNull(), report(field.raw, raw, F.lit(_reason(field.type)))))
        cleaned.append((strip_chars(value, field.strip) if field.strip else value).alias(field.name))
    wrongs = F.array_compact(F.array(*bad))
    kept = lines.withColumn("_fields", fields).select(
        *cleaned, "_file", "_split", "_at", "_header", F.when(F.size(wrongs) > 0, wrongs).alias("_bad")
    )
    return kept


def clean_with_rejects(spark: SparkSession, path: str, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    r"""The cleaned table of a dump, and its rejects.

    Rejects: ``file``, ``line`` (from 1, the header being line 1 of its file), ``column`` (the raw
    name, or ``fields``), ``raw`` (the field, or the whole line) and ``reason``; one row per value
    or line. NULL and empty fields are no rejects, and neither is a number in a flag.

    Every file has to begin with the same header, which has to name the columns of ``spec``; a
    file that does not is an error. Lines may end in CRLF. A missing field is NULL and a field too
    many is left out of the table, which keeps every line; an empty line counts as one with a
    single field. The dump is read once, apart from its first line: what was parsed is stored, and
    both results are taken from there.
    """
    header = _header(spark, path)
    names = header.removesuffix("\r").split("\t")
    lines = _lines(spark, path).withColumn("_header", (F.col("_split") == 0) & (F.col("value") == header))
    if header.endswith("\r"):
        lines = lines.withColumn("value", F.regexp_replace("value", "\r$", ""))
    stored = scratch_copy(_parsed(lines, spec, names), "parsed")

    splits = stored.groupBy("_file", "_split").agg(F.count(F.lit(1)).alias("_lines"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = scratch_copy(splits.withColumn("_before", F.coalesce(F.sum("_lines").over(earlier), F.lit(0))), "splits")
    # a later line may read like the header; only the first of a file is one
    firsts = splits.where("_split = 0").select("_file", F.col("_first").alias("_at"))
    headers = stored.where("_header").select("_file", "_at")
    other = firsts.join(headers, ["_file", "_at"], "left_anti").select("_file").limit(1).collect()
    if other:
        raise ValueError(f"another header in {unquote(other[0][0])}")

    rows = stored.where("not _header").unionByName(stored.where("_header").join(firsts, ["_file", "_at"], "left_anti"))
    bad = rows.where("_bad is not null").join(splits, ["_file", "_split"])
    line = F.col("_at") - F.col("_first") + F.col("_before") + 1
    bad = bad.select(F.col("_file").alias("file"), line.alias("line"), F.explode("_bad").alias("_b")).select("file", "line", "_b.*")
    return rows.select(*[f.name for f in spec.fields]), bad
