"""Build the cleaned (silver) and mart (gold) layers on storage."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from catalog_marts.operators import clean_table
from catalog_marts.sources import (
    SILVER,
    TableSpec,
    read_table,
    read_tsv,
    require_tables,
    scratch_scope,
    write_table,
)

from .marts import cast_mart, category_mart
from .together import run_all


def _build_silver_table(
    spark: SparkSession,
    spec: TableSpec,
    raw_path: str,
    path: str,
    n_files: int | None,
    cluster: str,
) -> str:
    cleaned = clean_table(read_tsv(spark, raw_path), spec)
    write_table(cleaned, path, spec.partition_by, spec.sort_by, n_files, cluster=cluster)
    return path


def build_silver(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    n_files: int | None = None,
    parallelism: int = 2,
    cluster: str = "range",
) -> dict[str, str]:
    """Clean every dump under ``raw_dir`` into ``out_dir/silver/<table>``.

    ``cluster="hash"`` reads each dump once instead of twice; see :func:`write_table`.
    """
    jobs = {
        name: partial(_build_silver_table, spark, spec, f"{raw_dir}/{spec.file}",
                      f"{out_dir}/silver/{name}", n_files, cluster)
        for name, spec in SILVER.items()
    }
    return run_all(spark, jobs, parallelism)


def read_silver(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The cleaned tables under ``root``, with their declared schemas."""
    paths = {name: f"{root}/silver/{name}" for name in SILVER}
    require_tables(spark, paths)
    return {name: read_table(spark, paths[name], SILVER[name].schema) for name in SILVER}


def build_gold(
    spark: SparkSession, root: str, max_records_per_file: int = 0, parallelism: int = 2
) -> dict[str, str]:
    """Build both marts from ``root/silver`` into ``root/gold``.

    The scratch tables of the build are removed at its end, also when it fails.
    """
    t = read_silver(spark, root)

    def movies() -> str:
        path = f"{root}/gold/category_wise_movies"
        mart = category_mart(t["titles"], t["ratings"], t["principals"], t["names"], t["akas"])
        write_table(mart, path, ["title_type", "genres"], "weighted_rating desc",
                    max_records_per_file=max_records_per_file)
        return path

    def cast() -> str:
        path = f"{root}/gold/top_category_wise_cast"
        write_table(cast_mart(t["principals"], t["ratings"], t["names"]), path, "category",
                    "avg_weighted_rating desc", max_records_per_file=max_records_per_file)
        return path

    jobs = {"category_wise_movies": movies, "top_category_wise_cast": cast}
    with scratch_scope(spark, "gold"):
        return run_all(spark, jobs, parallelism)
