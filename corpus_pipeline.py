"""From raw documents to token digests; every stage calls one operator of ``catalog_marts.llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_marts.llm.curriculum import mix_sources, training_order
from catalog_marts.llm.lines import deduplicate_lines
from catalog_marts.llm.minmax import near_duplicates
from catalog_marts.llm.queries import token_digest
from catalog_marts.llm.toxicity import fit_toxicity, score_toxicity
from catalog_marts.sources import scratch_copy

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5."""
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(docs, model, out="_toxicity").where("_toxicity < 0.5").select(*COLUMNS)


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line is similar to; ``n_chars`` follows the text.

    A document stays even if no line does.
    """
    left = deduplicate_lines(docs).withColumn("n_chars", F.length("text").cast("long"))
    return left.select(*COLUMNS)


def _content() -> Column:
    """Hash of all columns of a row; NULLs count as such."""
    return F.xxhash64(*COLUMNS, *(F.col(c).isNull() for c in COLUMNS))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: similarity 0.8 or more of five-word shingles.

    A row without an id is a document of its own, which a hash of the row names; these stay only
    where no row with an id is in their group. Of rows that repeat an id, with whatever texts, one
    stays, that with the smallest hash.
    """
    unnamed = F.xxhash64(F.lit("row"), _content()).bitwiseAND((1 << 62) - 1) + F.lit(1 << 62)
    named = docs.select(*COLUMNS, F.coalesce(F.col("doc_id").cast("long"), unnamed).alias("_id"))
    groups = near_duplicates(named, key="_id", words=5, percent=80).where("kept").select("_id").distinct()
    kept = named.join(scratch_copy(groups, "kept"), "_id", "left_semi")
    several = named.groupBy("_id").count().where("count > 1").select("_id")
    several = scratch_copy(several, "several")
    once = kept.join(several, "_id", "left_anti").select(*COLUMNS)
    one = kept.join(several, "_id", "left_semi").groupBy("_id").agg(F.min_by(F.struct(*COLUMNS), _content()).alias("_one"))
    return once.unionByName(one.select("_one.*"))


def in_training_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per use of a document in the mix of sources, in training order.

    Documents are used whole, up to three times; those that the mix has no use for go. Every row
    is a document, named by its id and a hash of the row; equal rows are used one by one. The
    files are written in training order.
    """
    name = F.concat_ws(":", F.col("doc_id").cast("string"), F.hex(_content()))
    docs = docs.select(*COLUMNS, name.alias("_use"))
    uses = training_order(mix_sources(docs, key="_use", whole=True)).withColumnRenamed("doc_id", "_use")
    return uses.join(docs.dropDuplicates(["_use"]), "_use").orderBy("position", "_use").select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token digests of every row."""
    return token_digest(docs)


STAGES: list[tuple[str, Callable]] = [
    ("toxicity", not_toxic),
    ("line_dedup", new_lines),
    ("minmax_dedup", one_of_each),
    ("curriculum_mix", in_training_order),
    ("byte_bpe", tokens),
]
ORACLE_SQL = None  # no stage but the fourth can be expressed; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch_copy(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
