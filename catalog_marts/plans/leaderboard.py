"""Keeping the cast leaderboard up to date from sums that credits can be taken out of again.

A credit's weighted rating is ``own + C * prior``: its title's rating by the weight of its votes, and
the mean rating C by the weight of the prior. Per person and role the leaderboard keeps the sums of
both and the number of credits, exactly, so a changed title takes its old credits out and puts its
new ones in, and a new mean needs no credits at all. Ranks come from a histogram of scores per
role: only scores that are new, gone or moved to another rank have rows to be written again.

Below the leaderboard's folder lie ``board`` (by role and band of scores), ``sums``, ``scores`` (the
histogram with ranks) and ``state`` (of the mean).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_marts.functions import non_blank
from catalog_marts.operators import dense_rank_spread
from catalog_marts.operators.ratings import PRIOR_VOTES
from catalog_marts.sources import GOLD_SCHEMAS, read_table, remove_folder, scratch_copy, write_table

from .marts import SCORE_DECIMALS
from .upkeep import STATE, mean_state, moved_state, state_mean

PERSON = ("primary_name", "birth_year", "death_year")
BANDS_PER_POINT = 4  # a role's rows lie in bands of a quarter of a rating point
BUCKETS = 32  # of the sums

_SUMS = "name_id string, category string, own decimal(38,18), prior decimal(38,18), credits bigint, rows bigint, _bucket int"
_SCORES = "category string, _score double, people bigint, rank int"
_ADDED = ("own", "prior", "credits", "rows")


def credit_sums(principals: DataFrame, ratings: DataFrame, sign: int = 1) -> DataFrame:
    """Sums per person and role: ``own``, ``prior``, ``credits`` (rated ones), ``rows`` (all)."""
    votes = F.col("num_votes").cast("double")
    rated = F.col("average_rating").isNotNull() & votes.isNotNull()
    part = lambda x: F.when(rated, x).cast("decimal(28,18)")
    own = part(F.try_divide(votes, votes + PRIOR_VOTES) * F.col("average_rating"))
    prior = part(F.try_divide(F.lit(PRIOR_VOTES), votes + PRIOR_VOTES))
    titles = ratings.select("title_id", own.alias("own"), prior.alias("prior"))
    credits = principals.select("title_id", "name_id", "category").join(titles, "title_id", "left")
    exact = lambda c: (F.coalesce(F.sum(c), F.lit(0)) * sign).cast("decimal(38,18)").alias(c)
    return credits.groupBy("name_id", "category").agg(
        exact("own"), exact("prior"), (F.count("own") * sign).alias("credits"), (F.count(F.lit(1)) * sign).alias("rows")
    )


def _added(*sums: DataFrame) -> DataFrame:
    both = reduce(DataFrame.unionByName, [s.select("name_id", "category", *_ADDED) for s in sums])
    total = [F.sum(c).cast(t).alias(c) for c, t in zip(_ADDED, ("decimal(38,18)", "decimal(38,18)", "bigint", "bigint"), strict=True)]
    return both.groupBy("name_id", "category").agg(*total)


def _bucket() -> Column:
    return F.pmod(F.xxhash64("name_id"), F.lit(BUCKETS)).cast("int").alias("_bucket")


def _scored(sums: DataFrame, mean: float | None) -> DataFrame:
    """Mean weighted rating and the score by which it ranks; NULL without rated credits."""
    own, prior = F.col("own").cast("double"), F.col("prior").cast("double")
    average = F.when(F.col("credits") > 0, (own + F.lit(mean).cast("double") * prior) / F.col("credits"))
    scored = sums.withColumn("avg_weighted_rating", average)
    return scored.withColumn("_score", F.round("avg_weighted_rating", SCORE_DECIMALS))


def _band(score: Column) -> Column:
    return F.coalesce(F.floor(score * BANDS_PER_POINT).cast("int"), F.lit(-1)).alias("_band")


def _bands(scores: DataFrame) -> DataFrame:
    """Partitions of the board that hold the rows of some scores."""
    return scores.select(non_blank(F.col("category"), "unknown").alias("_role"), _band(F.col("_score")))


def _ranked(histogram: DataFrame) -> DataFrame:
    """Rank of every score of a role; different scores alone, so a role's rows never meet."""
    ranked = dense_rank_spread(scratch_copy(histogram, "histogram"), "category", "_score")
    return scratch_copy(ranked.select("category", "_score", "people", "rank"), "ranks")


def _board(scored: DataFrame, names: DataFrame, ranks: DataFrame) -> DataFrame:
    people = names.groupBy("name_id", *PERSON).agg(F.count(F.lit(1)).alias("_copies"))
    ranks = ranks.select(F.col("category").alias("_category"), F.col("_score").alias("_of"), "rank")
    same = F.col("category").eqNullSafe(F.col("_category")) & F.col("_score").eqNullSafe(F.col("_of"))
    rows = scored.join(ranks, same).join(people, "name_id", "left")
    total = F.col("credits") * F.coalesce("_copies", F.lit(1))
    return rows.select("name_id", *PERSON, "category", "avg_weighted_rating", total.alias("total_movies"), "rank", _band(F.col("_score")))


def _write_board(rows: DataFrame, path: str, only_partitions: bool) -> None:
    write_table(rows, f"{path}/board", ["category", "_band"], "avg_weighted_rating desc", only_partitions=only_partitions)


def build_leaderboard(tables: Mapping[str, DataFrame], path: str) -> None:
    """Build the leaderboard and what :func:`refresh_leaderboard` needs below ``path``."""
    spark = tables["principals"].sparkSession
    state = scratch_copy(mean_state(tables["ratings"]), "mean")
    sums = scratch_copy(credit_sums(tables["principals"], tables["ratings"]).select("*", _bucket()), "sums")
    scored = scratch_copy(_scored(sums, state_mean(state)), "scored")
    ranks = _ranked(scored.groupBy("category", "_score").agg(F.count(F.lit(1)).alias("people")))
    _write_board(_board(scored, tables["names"], ranks), path, False)
    write_table(sums, f"{path}/sums", ["_bucket"])
    write_table(ranks, f"{path}/scores")
    write_table(spark.createDataFrame(state.collect(), STATE), f"{path}/state")


def open_leaderboard(spark: SparkSession, path: str) -> DataFrame:
    """The leaderboard with the columns of the cast mart."""
    return read_table(spark, f"{path}/board", GOLD_SCHEMAS["top_category_wise_cast"]).drop("_band")


def _keys(changes: Mapping[str, DataFrame], names: Sequence[str], key: str, like: DataFrame) -> DataFrame:
    found = [changes[n].select(key) for n in names if n in changes] or [like.select(key).limit(0)]
    return reduce(DataFrame.unionByName, found).where(F.col(key).isNotNull()).distinct()


def refresh_leaderboard(
    old: Mapping[str, DataFrame], new: Mapping[str, DataFrame], path: str, changes: Mapping[str, DataFrame]
) -> DataFrame:
    """Bring the leaderboard below ``path`` from the cleaned tables ``old`` to ``new``.

    ``changes`` are the changed keys of ``principals``, ``ratings`` and ``names`` (see
    ``changes_between``). Returns ``category``, ``band``, ``action`` and ``rows`` of the board's
    partitions: ``rewritten``, ``removed`` or ``kept``; kept ones keep their files. A band is
    written again if one of its scores is new, gone or ranks differently, or one of its people
    changed; all of them are when the mean rating moves.

    Credits are read for changed titles only, but the sums and, for the ranks, the different
    scores are read whole. What replaces a partition is stored before it is put in place.
    """
    spark = new["principals"].sparkSession
    titles = scratch_copy(_keys(changes, ("principals", "ratings"), "title_id", new["ratings"]), "titles")
    of = lambda tables, name: tables[name].join(titles, "title_id", "left_semi")
    state = read_table(spark, f"{path}/state", STATE)
    moved = scratch_copy(moved_state(state, of(old, "ratings"), of(new, "ratings")), "mean")
    before, mean = state_mean(state), state_mean(moved)

    delta = _added(*[credit_sums(of(t, "principals"), of(t, "ratings"), sign) for t, sign in ((old, -1), (new, 1))])
    delta = scratch_copy(delta.where(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in _ADDED])), "delta")
    had = read_table(spark, f"{path}/sums", _SUMS)
    buckets = scratch_copy(delta.select(_bucket()).distinct(), "buckets")
    sums = _added(had.join(buckets, "_bucket", "left_semi"), delta).where("rows > 0").select("*", _bucket())
    sums = scratch_copy(sums, "sums")
    everyone = had.join(buckets, "_bucket", "left_anti").unionByName(sums)
    scored = scratch_copy(_scored(everyone, mean), "scored")

    ranks_before = read_table(spark, f"{path}/scores", _SCORES)
    if mean == before:
        people = [F.col("name_id").eqNullSafe(F.col("_name")), F.col("category").eqNullSafe(F.col("_role"))]
        touched = delta.select(F.col("name_id").alias("_name"), F.col("category").alias("_role"))
        scores = [_scored(s, m).join(touched, people, "left_semi").select("category", "_score", F.lit(n).alias("people"))
                  for s, m, n in ((had, before, -1), (sums, mean, 1))]
        scores = scratch_copy(scores[0].unionByName(scores[1]), "moves")
        histogram = ranks_before.select("category", "_score", "people").unionByName(scores.withColumn("people", F.col("people").cast("bigint")))
        histogram = histogram.groupBy("category", "_score").agg(F.sum("people").alias("people")).where("people > 0")
    else:
        scores = None
        histogram = scored.groupBy("category", "_score").agg(F.count(F.lit(1)).alias("people"))
    ranks = _ranked(histogram)

    columns = ["category", "_score", "rank"]  # a score that is not in both lists with one rank
    moves = ranks.select(columns).exceptAll(ranks_before.select(columns)).unionByName(ranks_before.select(columns).exceptAll(ranks.select(columns)))
    known = _keys(changes, ("names",), "name_id", new["names"])
    bands = [_bands(moves), _bands(scored.join(known, "name_id", "left_semi"))] + ([_bands(scores)] if scores is not None else [])
    bands = scratch_copy(reduce(DataFrame.unionByName, bands).distinct(), "bands")
    affected = scored.withColumns({"_role": non_blank(F.col("category"), "unknown"), "_band": _band(F.col("_score"))})
    affected = affected.join(bands, ["_role", "_band"], "left_semi").drop("_role", "_band")
    rows = scratch_copy(_board(affected, new["names"], ranks), "board")

    board = read_table(spark, f"{path}/board", f"{GOLD_SCHEMAS['top_category_wise_cast']}, _band int")
    place = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")
    had_rows = board.select(F.col("category").alias("_role"), "_band", place).groupBy("_role", "_band").agg(
        F.min("folder").alias("folder"), F.count(F.lit(1)).alias("had")
    )
    now = rows.groupBy(non_blank(F.col("category"), "unknown").alias("_role"), "_band").agg(F.count(F.lit(1)).alias("now"))
    named = bands.join(now, ["_role", "_band"], "left").withColumn("_changed", F.lit(True))
    action = F.when(F.col("_changed").isNull(), "kept").when(F.col("now").isNull(), "removed").otherwise("rewritten")
    status = had_rows.join(named, ["_role", "_band"], "full").where("had is not null or now is not null")
    status = scratch_copy(status.withColumn("action", action), "status")

    _write_board(rows, path, True)
    for row in status.where("action = 'removed'").select("folder").collect():  # emptied partitions alone
        remove_folder(spark, unquote(row["folder"]))  # file paths come encoded
    write_table(sums, f"{path}/sums", ["_bucket"], only_partitions=True)
    for row in buckets.join(sums, "_bucket", "left_anti").collect():  # at most ``BUCKETS``
        remove_folder(spark, f"{path}/sums/_bucket={row['_bucket']}")
    write_table(ranks, f"{path}/scores")
    write_table(moved, f"{path}/state")
    for folder in ("board", "sums", "scores", "state"):
        spark.catalog.refreshByPath(f"{path}/{folder}")
    return status.select(F.col("_role").alias("category"), F.col("_band").alias("band"), "action", F.coalesce("now", "had").alias("rows"))
