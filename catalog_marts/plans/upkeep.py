"""Keeping the category mart up to date from what changed in the cleaned tables.

A title's rows in the mart depend on its own rows in the cleaned tables, on the names of the people
credited there, and on the mean rating of the whole table. The first two say which titles have to be
built again. The mean is kept as a sum and a count, from which retired ratings are taken and to
which new ones are added; where it moves, the weighted ratings of the other titles are computed
again from the mart's own columns, without a join.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_marts.functions import bayes_score
from catalog_marts.operators.ratings import PRIOR_VOTES
from catalog_marts.sources import GOLD_SCHEMAS, read_table, remove_folder, scratch_copy, write_table

from .marts import category_mart
from .versions import SUMS, hash_sums

LAYOUT = ["title_type", "genres"]
KEYS = {"titles": "title_id", "ratings": "title_id", "principals": "title_id", "akas": "title_id", "names": "name_id"}
STATE = "total decimal(38,12), ratings bigint"


def changed_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys whose rows differ between two states of a table: added, removed or changed in any column."""
    before = hash_sums(old, F.col(key)).select(F.col(key).alias("_key"), *[F.col(m).alias(f"old_{m}") for m in SUMS])
    same = reduce(lambda a, b: a & b, [F.col(m).eqNullSafe(F.col(f"old_{m}")) for m in SUMS])
    both = hash_sums(new, F.col(key)).join(before, F.col(key) == F.col("_key"), "full")
    return both.where(~same).select(F.coalesce(key, "_key").alias(key)).where(F.col(key).isNotNull())


def changes_between(old: Mapping[str, DataFrame], new: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Changed keys of every cleaned table; for those who do not know what changed."""
    return {name: changed_keys(old[name], new[name], key) for name, key in KEYS.items()}


def affected_titles(changes: Mapping[str, DataFrame], principals: DataFrame) -> DataFrame:
    """Titles whose rows may change: their own keys, and those credited to changed people.

    ``changes`` holds changed keys by table name; ``principals`` are the new credits (a credit that
    is gone is a change of its title).
    """
    found = [df.select("title_id") for name, df in changes.items() if KEYS[name] == "title_id"]
    if "names" in changes:
        people = changes["names"].select("name_id").distinct()
        found.append(principals.join(people, "name_id", "left_semi").select("title_id"))
    titles = reduce(DataFrame.unionByName, found)
    return titles.where("title_id is not null").distinct()


def mean_state(ratings: DataFrame) -> DataFrame:
    """One row: exact sum and number of the ratings. States of disjoint ratings add up."""
    exact = F.col("average_rating").cast("decimal(20,12)")
    return ratings.agg(F.coalesce(F.sum(exact), F.lit(0)).cast("decimal(38,12)").alias("total"), F.count(exact).alias("ratings"))


def moved_state(state: DataFrame, gone: DataFrame, come: DataFrame) -> DataFrame:
    """A state after some ratings were retired and others added."""
    signed = mean_state(gone).select((-F.col("total")).alias("total"), (-F.col("ratings")).alias("ratings"))
    both = state.unionByName(signed).unionByName(mean_state(come))
    return both.agg(F.sum("total").cast("decimal(38,12)").alias("total"), F.sum("ratings").alias("ratings"))


def state_mean(state: DataFrame) -> float | None:
    row = state.first()
    return float(row["total"] / row["ratings"]) if row["ratings"] else None


def build_mart(tables: Mapping[str, DataFrame], path: str) -> None:
    """Build the mart below ``path``: ``mart``, and ``state`` of the mean, for :func:`refresh_mart`."""
    spark = tables["titles"].sparkSession
    state = scratch_copy(mean_state(tables["ratings"]), "mean")
    mart = category_mart(*[tables[n] for n in ("titles", "ratings", "principals", "names", "akas")], mean=state_mean(state))
    write_table(mart, f"{path}/mart", LAYOUT, "weighted_rating desc")
    write_table(spark.createDataFrame(state.collect(), STATE), f"{path}/state")


def open_mart(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, f"{path}/mart", GOLD_SCHEMAS["category_wise_movies"])


def refresh_mart(
    old: Mapping[str, DataFrame],
    new: Mapping[str, DataFrame],
    path: str,
    changes: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Bring the mart below ``path`` from the cleaned tables ``old`` to ``new``.

    ``changes`` are the changed keys by table; left out, both states are compared. Of ``old`` only
    the ratings are read then. Returns ``title_type``, ``genres``, ``action`` and ``rows``:
    ``rewritten`` (rows now), ``removed`` (rows before) or ``kept``. Kept partitions keep their
    files; where the mean rating moved, no partition with a rated title can be kept.

    The rows of changed titles are built as :func:`category_mart` does, from the rows of these
    titles alone. They replace those of the mart in every partition that has had or gets any; what
    is rewritten is stored first, and put in place by a dynamic partition overwrite. Readers that
    must not see a mart in between open a published version of it.
    """
    spark = new["titles"].sparkSession
    changes = changes_between(old, new) if changes is None else changes
    touched = scratch_copy(affected_titles(changes, new["principals"]), "touched")

    state = read_table(spark, f"{path}/state", STATE)
    rated = changes["ratings"].select("title_id").distinct() if "ratings" in changes else touched.limit(0)
    moved = moved_state(state, *[t["ratings"].join(rated, "title_id", "left_semi") for t in (old, new)])
    moved = scratch_copy(moved, "mean")
    before, mean = state_mean(state), state_mean(moved)

    own = {n: new[n].join(touched, "title_id", "left_semi") for n in ("titles", "ratings", "principals", "akas")}
    fresh = category_mart(scratch_copy(own["titles"], "titles"), own["ratings"], own["principals"], new["names"], own["akas"], mean=mean)
    fresh = scratch_copy(fresh.fillna("unknown", LAYOUT), "fresh")
    mart = open_mart(spark, path)
    folder = F.regexp_replace("_file", "/[^/]*$", "")
    stale = mart.join(touched, "title_id", "left_semi")
    parts = stale.select(*LAYOUT).unionByName(fresh.select(*LAYOUT))
    if mean != before:
        parts = parts.unionByName(mart.where("average_rating is not null and num_votes is not null").select(*LAYOUT))
    parts = scratch_copy(parts.distinct(), "parts")

    rest = mart.join(parts, LAYOUT, "left_semi").join(touched, "title_id", "left_anti")
    if mean != before:
        score = bayes_score(F.col("average_rating"), F.col("num_votes"), F.lit(mean), PRIOR_VOTES)
        rest = rest.withColumn("weighted_rating", score)
    rows = scratch_copy(rest.select(mart.columns).unionByName(fresh.select(mart.columns)), "rewritten")

    now = rows.groupBy(*LAYOUT).agg(F.count(F.lit(1)).alias("now"))
    had = mart.groupBy(*LAYOUT, F.col("_metadata.file_path").alias("_file")).agg(F.count(F.lit(1)).alias("had"))
    had = had.groupBy(*LAYOUT).agg(F.min(folder).alias("folder"), F.sum("had").alias("had"))
    named = parts.join(now, LAYOUT, "left").withColumn("_changed", F.lit(True))
    action = F.when(F.col("_changed").isNull(), "kept").when(F.col("now").isNull(), "removed").otherwise("rewritten")
    status = scratch_copy(had.join(named, LAYOUT, "full").withColumn("action", action), "status")

    write_table(rows, f"{path}/mart", LAYOUT, "weighted_rating desc", only_partitions=True)
    for row in status.where("action = 'removed'").select("folder").collect():  # emptied partitions alone
        remove_folder(spark, unquote(row["folder"]))  # file paths come encoded
    write_table(moved, f"{path}/state")
    spark.catalog.refreshByPath(f"{path}/mart")
    return status.select(*LAYOUT, "action", F.coalesce("now", "had").alias("rows"))
