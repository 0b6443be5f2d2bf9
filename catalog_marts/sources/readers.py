"""Readers for raw dumps and stored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .specs import GOLD_SCHEMAS, SILVER

TSV_OPTIONS = {
    "sep": "\t", "header": True, "nullValue": "\\N", "quote": "", "escape": "", "lineSep": "\n"
}


def read_tsv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    r"""Tab-separated text with a header line and ``\N`` for NULL; every column is text.

    Types are not inferred: that would read the whole dump a second time and make a value's
    meaning depend on the other rows. Quotes and backslashes are ordinary characters, so a title
    that opens with ``"`` cannot swallow the fields after it; so are lone carriage returns. Lines
    may end in CRLF.

    ``columns`` are the names that the header must have, in order; left out, those of the first
    part. Every part's header is compared with them, and reading fails on one that differs.
    """
    found = spark.read.options(**TSV_OPTIONS).csv(path).columns
    crlf = bool(found) and found[-1].endswith("\r")
    names = list(columns) if columns else [*found[:-1], found[-1].removesuffix("\r")]
    last = names[-1]
    if crlf:
        names[-1] += "\r"
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    df = spark.read.options(**TSV_OPTIONS, enforceSchema=False).schema(schema).csv(path)
    if crlf:
        text = F.regexp_replace(F.col(f"`{names[-1]}`"), "\r$", "")
        value = F.when(~text.isin("\\N", ""), text)
        df = df.select(*[F.col(f"`{n}`") for n in names[:-1]], value.alias(last))
    return df


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def require_tables(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Open every table, or fail with one message that names all the missing ones."""
    found, missing = {}, []
    for name, path in paths.items():
        try:
            found[name] = spark.read.parquet(path)
        except AnalysisException as err:
            if err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            missing.append(f"{name} ({path})")
    if missing:
        raise FileNotFoundError("missing tables: " + ", ".join(missing))
    return found


def layer_paths(root: str) -> dict[str, tuple[str, str]]:
    """Table name -> (directory, schema) of every cleaned table and mart under ``root``."""
    silver = {f"silver_{n}": (f"{root}/silver/{n}", s.schema) for n, s in SILVER.items()}
    gold = {f"gold_{n}": (f"{root}/gold/{n}", s) for n, s in GOLD_SCHEMAS.items()}
    return {**silver, **gold}


def register_views(spark: SparkSession, root: str) -> list[str]:
    """Temp views ``silver_*`` and ``gold_*`` over the tables under ``root``, for SQL users."""
    paths = layer_paths(root)
    require_tables(spark, {name: path for name, (path, _) in paths.items()})
    for name, (path, schema) in paths.items():
        read_table(spark, path, schema).createOrReplaceTempView(name)
    return list(paths)
