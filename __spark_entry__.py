
from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_marts.fixtures import raw_table, silver_table, with_tables, write_dump
from catalog_marts.operators import (
    build_substring_index,
    clean_with_rejects,
    crew_rollup,
    dense_rank_spread,
    explode_category,
    left_join_spread,
    rating_totals,
    region_rollup,
    search_substrings,
    top_n_per_group,
    weighted_rating,
)
from catalog_marts.plans import (
    build_gold,
    build_silver,
    cast_mart,
    category_mart,
    check_keys,
    open_report,
    open_version,
    publish,
    publish_changes,
    report_q1,
    report_q2,
    report_q3,
    report_q4,
    store_report,
)
from catalog_marts.plans.contracts import RELATIONSHIPS, Relationship
from catalog_marts.plans.lattice import build_lattice, rating_statistics
from catalog_marts.plans.leaderboard import build_leaderboard, open_leaderboard, refresh_leaderboard
from catalog_marts.plans.publish import SERVING_TABLES
from catalog_marts.plans.together import run_all
from catalog_marts.plans.upkeep import build_mart, changes_between, open_mart, refresh_mart
from catalog_marts.sources import (
    GOLD_SCHEMAS,
    SILVER,
    read_table,
    read_tsv,
    register_views,
    require_tables,
    scratch_copy,
    scratch_dir,
    write_bucketed,
    write_table,
)

# Report parameters that fit the value ranges of the given tables.
TYPE, MIN_RATING, MIN_VOTES, TOP_K = "ECONOMY", 4.7, 7000, 100
TERMS = ("Small", "ring")
SEARCHED = (*TERMS, "dget", "t G", "W", '" x', "\\", "old widget", "nowhere")
YEARLY_VOTES, YEARLY_TOP = 5000, 3
GOLD_VIEW = "gold_category_wise_movies"


def entry(spark: SparkSession) -> DataFrame:
    """Rating trend per year and title type on the smallest data set."""
    return queries()["report_q1"](spark, "/root/testdata/sf0.001")


# ---- Spark side -----------------------------------------------------------------------------


def _silver(spark, sf_dir, *names):
    return [silver_table(spark, sf_dir, n) for n in names]


def _rated_rows(spark, sf_dir) -> DataFrame:
    """The part of the category mart that the reports read: titles x genres with ratings."""
    titles, ratings = _silver(spark, sf_dir, "titles", "ratings")
    return explode_category(left_join_spread(titles, "title_id", weighted_rating(ratings)))


def _mart(spark, sf_dir) -> DataFrame:
    return category_mart(
        *_silver(spark, sf_dir, "titles", "ratings", "principals", "names", "akas")
    )


def _cast(spark, sf_dir, **options) -> DataFrame:
    cast = cast_mart(*_silver(spark, sf_dir, "principals", "ratings", "names"), **options)
    return cast.withColumn("rank", F.col("rank").cast("bigint"))


def _stored_mart(spark, sf_dir) -> DataFrame:
    """The mart written in its partitioned, sorted layout, and read back."""
    path = scratch_dir(spark, "category-mart")
    write_table(_mart(spark, sf_dir), path, ["title_type", "genres"], "weighted_rating desc")
    return read_table(spark, path, GOLD_SCHEMAS["category_wise_movies"])


def _stored_cast(spark, sf_dir) -> DataFrame:
    path = scratch_dir(spark, "cast-mart")
    cast = cast_mart(*_silver(spark, sf_dir, "principals", "ratings", "names"))
    write_table(cast, path, "category", "avg_weighted_rating desc")
    stored = read_table(spark, path, GOLD_SCHEMAS["top_category_wise_cast"])
    return stored.withColumn("rank", F.col("rank").cast("bigint"))


def _built(spark, sf_dir) -> str:
    """Root of all layers, built from text dumps."""
    root = scratch_dir(spark, "layers")
    dumps = {
        name: partial(write_dump, raw_table(spark, sf_dir, name), f"{root}/raw/{spec.file}")
        for name, spec in SILVER.items()
    }
    run_all(spark, dumps, len(dumps))
    build_silver(spark, f"{root}/raw", root, parallelism=len(SILVER))
    build_gold(spark, root)
    return root


def _built_gold(spark, sf_dir, name) -> DataFrame:
    gold = read_table(spark, f"{_built(spark, sf_dir)}/gold/{name}", GOLD_SCHEMAS[name])
    return gold.withColumn("rank", F.col("rank").cast("bigint")) if "rank" in gold.columns else gold


def _sql(spark, sf_dir, query) -> DataFrame:
    """A report as SQL text on the registered views."""
    register_views(spark, _built(spark, sf_dir))
    return spark.sql(query)


def _sorted_roundtrip(spark, sf_dir) -> DataFrame:
    path = scratch_dir(spark, "silver-akas")
    spec = SILVER["akas"]
    write_table(silver_table(spark, sf_dir, "akas"), path, sort_by=spec.sort_by)
    return read_table(spark, path, spec.schema)


def _tsv_roundtrip(spark, sf_dir) -> DataFrame:
    path = scratch_dir(spark, "raw-titles")
    write_dump(raw_table(spark, sf_dir, "titles"), path)
    return read_tsv(spark, path)


def _rejects(spark, sf_dir) -> DataFrame:
    """What the cleaned tables could not take in from text dumps, by value."""
    root, found = scratch_dir(spark, "dirty"), []
    for name, spec in SILVER.items():
        write_dump(raw_table(spark, sf_dir, name), f"{root}/{spec.file}")
        _, bad = clean_with_rejects(spark, f"{root}/{spec.file}", spec)
        bad = bad.groupBy("column", "raw", "reason").agg(F.count(F.lit(1)).alias("rows"))
        found.append(bad.withColumn("table", F.lit(name)))
    return reduce(DataFrame.unionByName, found)


def _published(spark, sf_dir) -> DataFrame:
    root = _built(spark, sf_dir)
    register_views(spark, root)
    tables = {name: spark.table(name) for name in SERVING_TABLES}
    status = publish(spark, tables, f"{root}/serving")
    return status.select("table", "rows", "ok")


def _keys(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Join keys of all tables; the releases stand in as a further right side, with many copies."""
    tables = {name: silver_table(spark, sf_dir, name) for name in SILVER}
    return check_keys(tables, (*RELATIONSHIPS, Relationship("titles", "title_id", "akas", "title_id")))


# What happens to the titles between two publishings, in the SQL that both sides share.
_STILL_LISTED = "coalesce(runtime_minutes % 7, 0) <> 3 or title_type <> 'PROMO'"
_RENAMED = "case when start_year = 2011 then concat(primary_title, ' II') else primary_title end"


def _published_twice(spark, sf_dir) -> tuple[str, DataFrame]:
    """Titles by type and genre, published, changed and published again."""
    root = f"{scratch_dir(spark, 'serving')}/titles"
    titles = _silver(spark, sf_dir, "titles")[0]
    changed = titles.where(_STILL_LISTED).withColumn("primary_title", F.expr(_RENAMED))
    for version in (titles, changed):
        parts = publish_changes(explode_category(version), root, ["title_type", "genres"], ["title_id"])
    return root, parts


# What happens to every cleaned table before a mart is brought up to date: rows go, change and come.
_NEXT = {
    "titles": (_STILL_LISTED, {"primary_title": _RENAMED}, "title_id like '%99'", {"title_id": "concat(title_id, 'n')"}),
    "ratings": ("num_votes % 110 <> 50", {"num_votes": "case when title_id like '%7' then num_votes + 40 else num_votes end"},
                "title_id like '%98'", {"title_id": "concat('tt', num_votes)"}),
    "principals": ("coalesce(ordering % 13, 0) <> 4", {"category": "case when job = 'R' then 'director' else category end"},
                   "title_id like '%99'", {"title_id": "concat(title_id, 'n')"}),
    "names": ("birth_year <> 1903", {"primary_name": "case when birth_year = 1910 then concat(primary_name, ' Jr') else primary_name end"},
              "birth_year = 1905", {"name_id": "concat(name_id, 'b')"}),
    "akas": ("region is null or region <> 'FRANCE'", {"region": "case when language = 'asia' then 'EAST' else region end"},
             "title_id like '%99'", {"title_id": "concat(title_id, 'n')"}),
}


def _next_state(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    after = {}
    for name, (stays, changed, copied, renamed) in _NEXT.items():
        set_to = lambda df, how: df.withColumns({c: F.expr(e) for c, e in how.items()})
        after[name] = set_to(tables[name].where(stays), changed).unionByName(set_to(tables[name].where(copied), renamed))
    return after


def _two_states(spark, sf_dir) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    before = _copies(spark, {name: silver_table(spark, sf_dir, name) for name in SILVER})
    return before, _copies(spark, _next_state(before))


def _copies(spark, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return run_all(spark, {name: partial(scratch_copy, df, name) for name, df in tables.items()}, len(tables))


def _kept_up(spark, sf_dir) -> DataFrame:
    """The category mart built from the tables before, then brought up to date."""
    before, after = _two_states(spark, sf_dir)
    path = scratch_dir(spark, "kept-up")
    build_mart(before, path)
    refresh_mart(before, after, path)
    return open_mart(spark, path)


def _kept_up_cast(spark, sf_dir) -> DataFrame:
    """The same for the leaderboard, whose rows come from sums."""
    before, after = _two_states(spark, sf_dir)
    path = scratch_dir(spark, "leaderboard")
    build_leaderboard(before, path)
    refresh_leaderboard(before, after, path, changes_between(before, after))
    return open_leaderboard(spark, path).withColumn("rank", F.col("rank").cast("bigint"))


def _sink(spark, sf_dir, **options) -> DataFrame:
    """Credits through a sink and back."""
    path = scratch_dir(spark, "sink")
    write_table(silver_table(spark, sf_dir, "principals"), path, **options)
    return read_table(spark, path, SILVER["principals"].schema)


def _hot_join(spark, sf_dir) -> DataFrame:
    """Lines joined to totals of their key; one key holds a third of the lines."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.when(F.col("l_returnflag") == "A", -1).when(F.col("l_partkey") % 7 > 0, F.col("l_partkey"))
        .alias("k"),
    )
    totals = lines.groupBy("k").agg(F.sum("l_quantity").alias("total"), F.count("*").alias("lines"))
    return left_join_spread(lines, "k", totals)


def _q1(spark, sf_dir):
    return report_q1(*_silver(spark, sf_dir, "titles", "ratings"))


def _lattice(spark, sf_dir) -> str:
    path = scratch_dir(spark, "lattice")
    titles, ratings = _silver(spark, sf_dir, "titles", "ratings")
    build_lattice(titles.join(ratings, "title_id"), path)
    return path


def _groupings(spark, sf_dir) -> DataFrame:
    """Every grouping by decade and type, of the years from 1990 on, each from its own level."""
    path, found = _lattice(spark, sf_dir), []
    for by in (("decade", "title_type"), ("decade",), ("title_type",), ()):
        rows = rating_statistics(spark, path, by, between={"decade": (1990, 2020)}, decimals=6)
        missing = {"decade": F.lit(None).cast("int"), "title_type": F.lit(None).cast("string")}
        rows = rows.withColumns({d: c for d, c in missing.items() if d not in by})
        found.append(rows.withColumn("grouping", F.lit("-".join(by))))
    return reduce(DataFrame.unionByName, found)


def _q2_kept(spark, sf_dir) -> DataFrame:
    """The second report over the built layers, stored, and opened with its row order."""
    root = _built(spark, sf_dir)
    paths = {name: f"{root}/gold/{name}" for name in GOLD_SCHEMAS} | {name: f"{root}/silver/{name}" for name in SILVER}
    require_tables(spark, paths)
    store_report(_q2(read_table(spark, paths["category_wise_movies"], GOLD_SCHEMAS["category_wise_movies"])), f"{root}/q2")
    return open_report(spark, f"{root}/q2")


def _q1_bucketed(spark, sf_dir):
    """The same report on tables bucketed by title, which join without a shuffle."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored, made = [], []
    for name in ("titles", "ratings"):
        path = scratch_dir(spark, f"bucketed-{name}")
        made.append(f"bucketed_{path.rsplit('-', 1)[1]}")
        frame = silver_table(spark, sf_dir, name)
        stored.append(write_bucketed(frame, made[-1], path, ["title_id"], buckets))
    report = report_q1(*stored)
    for table in made:  # only the catalog entries; the files are external
        spark.sql(f"drop table {table}")
    return report


def _q2(mart):
    return report_q2(mart, TYPE, MIN_RATING, MIN_VOTES, TOP_K)


def _q3(mart, **options):
    return report_q3(mart, TERMS, **options)


def _q4(mart, **options):
    report = report_q4(mart, TYPE, YEARLY_VOTES, YEARLY_TOP, **options)
    return report.withColumn("rank_in_year", F.col("rank_in_year").cast("bigint"))


def _searched(spark, sf_dir, terms) -> DataFrame:
    """Titles that contain a term, from the substring index."""
    path = scratch_dir(spark, "substrings")
    build_substring_index(_silver(spark, sf_dir, "titles")[0], path, "title_id", "primary_title")
    return search_substrings(spark, path, terms)


def _q3_indexed(spark, sf_dir) -> DataFrame:
    found = _searched(spark, sf_dir, TERMS).select(F.col("key").alias("title_id")).distinct()
    return _q3(_rated_rows(spark, sf_dir).join(found, "title_id", "left_semi"))


def _top_customers(spark, sf_dir):
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    spend = (
        spark.read.parquet(f"{sf_dir}/orders.parquet")
        .groupBy("o_custkey")
        .agg(F.round(F.sum("o_totalprice"), 2).alias("spend"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select("c_nationkey", "c_custkey", "spend")
    )
    top = top_n_per_group(spend, ["c_nationkey"], ["spend desc"], 3, "spend_rank")
    return top.withColumn("spend_rank", F.col("spend_rank").cast("bigint"))


def _ranked_lines(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"
    )
    ranked = dense_rank_spread(lines, "l_returnflag", "l_extendedprice", "price_rank", chunks=16)
    return ranked.withColumn("price_rank", F.col("price_rank").cast("bigint"))


def _training_data():
    """Queries and SQL of the training-data operators; both empty where these are not installed."""
    try:
        import corpus_pipeline
        from catalog_marts.llm import queries as own
    except ModuleNotFoundError as e:
        if e.name in ("corpus_pipeline", "catalog_marts.llm"):
            return {}, {}
        raise
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**own.queries(), "pipeline": corpus_pipeline.run}, {**own.oracle_sql(), **sql}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator."""
    clean = {f"clean_{n}": lambda s, d, n=n: silver_table(s, d, n) for n in SILVER}
    return {
        "report_q1": _q1,
        "report_q1_bucketed": _q1_bucketed,
        "report_q1_lattice": lambda s, d: rating_statistics(
            s, _lattice(s, d), ["start_year", "title_type"], between={"start_year": (1980, 2025)}
        ),
        "lattice_groupings": _groupings,
        "report_q2": lambda s, d: _q2(_rated_rows(s, d)),
        "report_q3": lambda s, d: _q3(_rated_rows(s, d)),
        "report_q3_title_grain": lambda s, d: _q3(_rated_rows(s, d), grain="title"),
        "report_q3_capped": lambda s, d: _q3(_rated_rows(s, d), max_rows=3),
        "report_q2_kept": _q2_kept,
        "report_q3_indexed": _q3_indexed,
        "substring_search": lambda s, d: _searched(s, d, SEARCHED),
        "report_q4": lambda s, d: _q4(_rated_rows(s, d)),
        "report_q2_stored": lambda s, d: _q2(_stored_mart(s, d)),
        "report_q3_stored": lambda s, d: _q3(_stored_mart(s, d)),
        "report_q4_stored": lambda s, d: _q4(_stored_mart(s, d), keep_id=True),
        "weighted_rating": lambda s, d: weighted_rating(*_silver(s, d, "ratings")),
        "rating_totals": lambda s, d: rating_totals(*_silver(s, d, "ratings")),
        "explode_category": lambda s, d: explode_category(*_silver(s, d, "titles")).select(
            "title_id", "genres"
        ),
        "crew_rollup": lambda s, d: crew_rollup(*_silver(s, d, "principals", "names")),
        "region_rollup": lambda s, d: region_rollup(*_silver(s, d, "akas")),
        "region_rollup_distinct": lambda s, d: region_rollup(
            *_silver(s, d, "akas"), distinct=True
        ),
        "category_mart": _mart,
        "cast_mart": _cast,
        "cast_mart_top": lambda s, d: _cast(s, d, min_titles=5, top_n=10),
        "top_n_per_group": _top_customers,
        "dense_rank_distributed": _ranked_lines,
        "scan_tsv_roundtrip": _tsv_roundtrip,
        **clean,
        "sink_sorted_roundtrip": _sorted_roundtrip,
        "sink_partitioned_roundtrip": _stored_mart,
        "sink_cast_roundtrip": _stored_cast,
        "sink_fixed_files": lambda s, d: _sink(s, d, sort_by="title_id", n_files=3),
        "sink_curve_clustered": lambda s, d: _sink(s, d, sort_by=["title_id", "name_id", "category"], cluster="curve"),
        "sink_partitioned_unsorted": lambda s, d: _sink(s, d, partition_by="category"),
        "sink_plain": lambda s, d: _sink(s, d),
        "left_join_hot_key": _hot_join,
        "publish_status": _published,
        "scan_rejects": _rejects,
        "mart_upkeep": _kept_up,
        "leaderboard_upkeep": _kept_up_cast,
        "key_contracts": lambda s, d: _keys(s, d)[0],
        "key_orphans": lambda s, d: _keys(s, d)[1],
        "publish_changed_parts": lambda s, d: _published_twice(s, d)[1],
        "publish_changed_table": lambda s, d: open_version(s, _published_twice(s, d)[0]),
        "build_category_mart": lambda s, d: _built_gold(s, d, "category_wise_movies"),
        "build_cast_mart": lambda s, d: _built_gold(s, d, "top_category_wise_cast"),
        "sql_report_q1": lambda s, d: _sql(
            s, d, _Q1.format(titles="silver_titles", ratings="silver_ratings")
        ),
        "sql_report_q2": lambda s, d: _sql(s, d, _Q2.format(mart=GOLD_VIEW)),
        "sql_report_q3": lambda s, d: _sql(s, d, _Q3.format(mart=GOLD_VIEW)),
        "sql_report_q4": lambda s, d: _sql(s, d, _Q4.format(columns="*", mart=GOLD_VIEW)),
        **_training_data()[0],
    }


# ---- SQL side -------------------------------------------------------------------------------

_WEIGHTED = """
select title_id, average_rating, num_votes,
  (cast(num_votes as double) / (num_votes + 1000.0::double)) * average_rating
  + (1000.0::double / (num_votes + 1000.0::double))
    * (select avg(average_rating) from ratings) as weighted_rating
from ratings"""

_CREW = """
select title_id,
  coalesce(string_agg(primary_name, ',' order by ordering nulls first, primary_name)
    filter (where category in ('actor', 'actress')), '') as actors,
  coalesce(string_agg(primary_name, ',' order by ordering nulls first, primary_name)
    filter (where category = 'director'), '') as directors,
  coalesce(string_agg(primary_name, ',' order by ordering nulls first, primary_name)
    filter (where category = 'producer'), '') as producers
from principals left join names using (name_id)
group by title_id"""

_REGIONS = """
select title_id, string_agg({distinct} region, ',' order by region) as regions,
  count(distinct region) as region_count
from akas where region <> 'Unknown' group by title_id"""

_EXPLODED = """
select {columns}, coalesce(nullif(trim(token), ''), 'unknown') as genres
from (select *, unnest(coalesce(string_split(genres, ','), [null])) as token from {source})"""

_TITLE_COLUMNS = ("title_id, title_type, primary_title, original_title, is_adult, start_year, "
                  "end_year, runtime_minutes")
_FACT_COLUMNS = ("average_rating, num_votes, weighted_rating, actors, directors, producers, "
                 "regions, region_count")

_MART = f"""
weighted as ({_WEIGHTED}),
crew as ({_CREW}),
released as ({_REGIONS.format(distinct='')}),
wide as (
  select t.*, w.average_rating, w.num_votes, w.weighted_rating, c.actors, c.directors,
    c.producers, g.regions, g.region_count
  from titles t left join weighted w using (title_id) left join crew c using (title_id)
    left join released g using (title_id)),
mart as ({_EXPLODED.format(columns=_TITLE_COLUMNS + ', ' + _FACT_COLUMNS, source='wide')})"""

_CAST = f"""
weighted as ({_WEIGHTED}),
people as (
  select name_id, primary_name, category, birth_year, death_year,
    avg(weighted_rating) as avg_weighted_rating,
    count(weighted_rating) as total_movies
  from principals left join weighted using (title_id) left join names using (name_id)
  group by all)"""

_CAST_RANKED = """
select *, cast(dense_rank() over (partition by category
  order by round(avg_weighted_rating, 9) desc nulls last) as bigint) as rank from {source}"""

_Q1 = """
select start_year, title_type, count(*) as total_titles,
  round(avg(average_rating), 2) as avg_rating, max(num_votes) as max_votes
from {titles} join {ratings} using (title_id)
where start_year between 1980 and 2025 group by all"""

_GROUPINGS = """
, rated as (
  select title_type, cast(floor(start_year / 10) * 10 as int) as decade, average_rating, num_votes
  from titles join ratings using (title_id)
  where start_year between 1990 and 2029)
select case when grouping(decade) + grouping(title_type) = 0 then 'decade-title_type' when grouping(decade) = 0 then 'decade'
    when grouping(title_type) = 0 then 'title_type' else '' end as "grouping",
  decade, title_type, count(*) as total_titles, round(avg(average_rating), 6) as avg_rating, max(num_votes) as max_votes
from rated group by grouping sets ((decade, title_type), (decade), (title_type), ())"""

_Q2 = f"""
select distinct title_id, primary_title, start_year, average_rating, num_votes from {{mart}}
where title_type = '{TYPE}' and average_rating >= cast({MIN_RATING} as float)
  and num_votes >= {MIN_VOTES}
order by average_rating desc, num_votes desc, title_id limit {TOP_K}"""

_Q3_MATCH = " or ".join(f"lower(primary_title) like '%{t.lower()}%'" for t in TERMS)
_Q3 = f"""
select title_type, count(distinct title_id) as match_count,
  round(avg(average_rating), 2) as avg_rating
from {{mart}} where {_Q3_MATCH} group by title_type"""

_SEARCH = " union all ".join(
    f"""select '{t}' as term, title_id as key, primary_title as text
from titles where contains(lower(primary_title), '{t.lower()}')"""
    for t in SEARCHED
)

_Q4 = f"""
select {{columns}} from (
  select *, cast(dense_rank() over (partition by start_year
    order by average_rating desc nulls last, num_votes desc nulls last) as bigint)
    as rank_in_year
  from (select distinct title_id, primary_title, start_year, average_rating, num_votes
        from {{mart}} where title_type = '{TYPE}' and num_votes > {YEARLY_VOTES}))
where rank_in_year <= {YEARLY_TOP}"""


# What cleaning has to give, spelt out column by column: independent of the specifications.
_CLEAN = {
    "names": """
select
  nconst as name_id,
  primaryName as primary_name,
  try_cast(birthYear as int) as birth_year,
  try_cast(deathYear as int) as death_year,
  primaryProfession as primary_profession,
  knownForTitles as known_for_titles
from raw_names""",
    "principals": """
select
  tconst as title_id,
  try_cast(ordering as int) as ordering,
  nconst as name_id,
  category as category,
  job as job,
  replace(replace(replace(characters, '[', ''), ']', ''), '"', '') as characters
from raw_principals""",
    "akas": """
select
  titleId as title_id,
  try_cast(ordering as int) as ordering,
  title as title,
  region as region,
  language as language,
  types as types,
  attributes as attributes,
  coalesce(try_cast(try_cast(isOriginalTitle as int) as boolean), try_cast(isOriginalTitle as boolean)) as is_original_title
from raw_akas""",
    "titles": """
select
  tconst as title_id,
  titleType as title_type,
  primaryTitle as primary_title,
  originalTitle as original_title,
  coalesce(try_cast(try_cast(isAdult as int) as boolean), try_cast(isAdult as boolean)) as is_adult,
  try_cast(startYear as int) as start_year,
  try_cast(endYear as int) as end_year,
  try_cast(runtimeMinutes as int) as runtime_minutes,
  replace(replace(replace(replace(genres, '[', ''), ']', ''), '"', ''), ' ', '') as genres
from raw_titles""",
    "ratings": """
select
  tconst as title_id,
  try_cast(averageRating as float) as average_rating,
  try_cast(numVotes as int) as num_votes
from raw_ratings""",
}


# The relationships spelt out: left table, its key, right table, its key.
_LINKS = (
    ("principals", "name_id", "names", "name_id"), ("titles", "title_id", "ratings", "title_id"),
    ("principals", "title_id", "ratings", "title_id"), ("ratings", "title_id", "titles", "title_id"),
    ("principals", "title_id", "titles", "title_id"), ("akas", "title_id", "titles", "title_id"),
    ("titles", "title_id", "akas", "title_id"),
)
_KEYS = " union all ".join(
    f"""select '{lt}.{lk} -> {rt}.{rk}' as relationship, count(*) as rows, count(*) - count({lk}) as null_rows,
  count(distinct {lk}) as keys,
  count(distinct {lk}) filter (where {lk} not in (select {rk} from {rt} where {rk} is not null)) as orphan_keys,
  count(*) filter (where {lk} not in (select {rk} from {rt} where {rk} is not null)) as orphan_rows,
  (select count(distinct {rk}) from {rt}) as right_keys,
  (select count(*) from (select {rk} from {rt} where {rk} is not null group by {rk} having count(*) > 1)) as duplicate_keys,
  (select count({rk}) - count(distinct {rk}) from {rt}) as duplicate_rows
from {lt}"""
    for lt, lk, rt, rk in _LINKS
)
_ORPHANS = " union all ".join(
    f"""select '{lt}.{lk} -> {rt}.{rk}' as relationship, {lk} as key, count(*) as rows
from {lt} where {lk} not in (select {rk} from {rt} where {rk} is not null) group by {lk}"""
    for lt, lk, rt, rk in _LINKS
)

_CHANGED = f"""
changed as (select * replace ({_RENAMED} as primary_title) from titles where {_STILL_LISTED}),
before as ({_EXPLODED.format(columns=_TITLE_COLUMNS, source='titles')}),
after as ({_EXPLODED.format(columns=_TITLE_COLUMNS, source='changed')})"""

_CHANGED_PARTS = """
, old as (select title_type, genres, count(*) as n from before group by all),
new as (select title_type, genres, count(*) as n from after group by all),
gone as (select * from before except all select * from after),
come as (select * from after except all select * from before),
differs as (select title_type, genres from gone union select title_type, genres from come)
select '{"title_type":' || to_json(p.title_type) || ',"genres":' || to_json(p.genres) || '}' as part,
  case when new.n is null then 'removed' when d.genres is not null then 'written' else 'kept' end as action,
  coalesce(new.n, old.n) as rows
from (select title_type, genres from old union select title_type, genres from new) p
left join old using (title_type, genres) left join new using (title_type, genres)
left join differs d using (title_type, genres)"""


# Values that are no number or no flag; an empty field is none.
_TYPED = {
    "titles": {"isAdult": "boolean", "startYear": "int", "endYear": "int", "runtimeMinutes": "int"},
    "ratings": {"averageRating": "float", "numVotes": "int"},
    "names": {"birthYear": "int", "deathYear": "int"},
    "principals": {"ordering": "int"},
    "akas": {"ordering": "int", "isOriginalTitle": "boolean"},
}
_NO_FLAG = "try_cast({c} as int) is null and try_cast({c} as boolean) is null"
_REJECTS = " union all ".join(
    f"""select '{table}' as "table", '{c}' as "column", {c} as raw, 'no {kind}' as reason, count(*) as rows
from raw_{table} where {c} <> '' and {_NO_FLAG.format(c=c) if kind == 'boolean' else f'try_cast({c} as {kind}) is null'}
group by {c}"""
    for table, columns in _TYPED.items()
    for c, kind in columns.items()
)


def _set_to(how: dict[str, str]) -> str:
    return ", ".join(f"{e} as {c}" for c, e in how.items())


#: The tables after the changes, under the names of the tables, for what follows.
_AFTER = ", ".join(
    f"""next_{name} as (
  select * replace ({_set_to(changed)}) from {name} where {stays}
  union all select * replace ({_set_to(renamed)}) from {name} where {copied})"""
    for name, (stays, changed, copied, renamed) in _NEXT.items()
)
_SHADOWED = ", ".join(f"{name} as (select * from next_{name})" for name in _NEXT)


def _over(ctes: str, body: str) -> str:
    return with_tables(f", {ctes.strip()}\n{body}")


def oracle_sql() -> dict[str, str]:
    """The same results as plain SQL over the given tables."""
    q1 = with_tables(_Q1.format(titles="titles", ratings="ratings"))
    q2 = _over(_MART, _Q2.format(mart="mart"))
    q3 = _over(_MART, _Q3.format(mart="mart"))
    q4 = _over(_MART, _Q4.format(columns="*", mart="mart"))
    mart = _over(_MART, "select * from mart")
    cast = _over(_CAST, _CAST_RANKED.format(source="people"))
    strong = "(select * from people where total_movies >= 5)"
    status = " union all ".join(
        f"select 'silver_{n}' as \"table\", count(*) as rows, true as ok from {n}" for n in SILVER
    )
    return {
        "report_q1": q1,
        "report_q1_bucketed": q1,
        "report_q1_lattice": q1,
        "lattice_groupings": with_tables(_GROUPINGS),
        "report_q2": q2,
        "report_q3": q3,
        "report_q3_title_grain": _over(
            _MART,
            _Q3.format(mart="(select distinct title_type, title_id, primary_title, "
                              "average_rating from mart)"),
        ),
        "report_q3_capped": _over(
            _MART, f"{_Q3.format(mart='mart')} order by match_count desc, title_type limit 3"
        ),
        "report_q2_kept": _over(
            _MART, f"select *, row_number() over (order by average_rating desc, num_votes desc, title_id) as position from ({_Q2.format(mart='mart')})"
        ),
        "report_q3_indexed": q3,
        "substring_search": with_tables(_SEARCH),
        "report_q4": _over(_MART, _Q4.format(columns="* exclude (title_id)", mart="mart")),
        "report_q2_stored": q2,
        "report_q3_stored": q3,
        "report_q4_stored": q4,
        "weighted_rating": with_tables(_WEIGHTED),
        "rating_totals": with_tables(
            "select avg(average_rating) as overall_avg, "
            "cast(sum(num_votes) as bigint) as total_votes from ratings"
        ),
        "explode_category": with_tables(_EXPLODED.format(columns="title_id", source="titles")),
        "crew_rollup": with_tables(_CREW),
        "region_rollup": with_tables(_REGIONS.format(distinct="")),
        "region_rollup_distinct": with_tables(_REGIONS.format(distinct="distinct")),
        "category_mart": mart,
        "cast_mart": cast,
        "cast_mart_top": _over(
            _CAST,
            f"select * from ({_CAST_RANKED.format(source=strong)}) where rank <= 10",
        ),
        "top_n_per_group": """
select * from (
  select c_nationkey, c_custkey, spend, cast(dense_rank() over (partition by c_nationkey
    order by spend desc) as bigint) as spend_rank
  from (select c_nationkey, c_custkey, round(sum(o_totalprice), 2) as spend
        from orders join customer on o_custkey = c_custkey group by all))
where spend_rank <= 3""",
        "dense_rank_distributed": """
select l_orderkey, l_linenumber, l_returnflag, l_extendedprice,
  cast(dense_rank() over (partition by l_returnflag order by l_extendedprice desc) as bigint)
    as price_rank
from lineitem""",
        # an empty field of a dump reads as NULL
        "scan_tsv_roundtrip": with_tables(
            "select * replace (nullif(genres, '') as genres) from raw_titles"
        ),
        **{f"clean_{n}": with_tables(sql) for n, sql in _CLEAN.items()},
        "sink_sorted_roundtrip": with_tables("select * from akas"),
        "sink_partitioned_roundtrip": mart,
        "sink_cast_roundtrip": cast,
        "publish_status": f"""
with silver as ({with_tables(status)})
select * from silver
union all select 'gold_category_wise_movies', (select count(*) from ({mart})), true
union all select 'gold_top_category_wise_cast', (select count(*) from ({cast})), true""",
        "scan_rejects": with_tables(_REJECTS),
        "mart_upkeep": _over(_AFTER, f"select * from (with {_SHADOWED}, {_MART.strip()} select * from mart)"),
        "leaderboard_upkeep": _over(
            _AFTER, f"select * from (with {_SHADOWED}, {_CAST.strip()} {_CAST_RANKED.format(source='people')})"
        ),
        "key_contracts": with_tables(_KEYS),
        "key_orphans": with_tables(_ORPHANS),
        "publish_changed_parts": _over(_CHANGED, _CHANGED_PARTS),
        "publish_changed_table": _over(_CHANGED, "select * from after"),
        "sink_fixed_files": with_tables("select * from principals"),
        "sink_curve_clustered": with_tables("select * from principals"),
        "sink_partitioned_unsorted": with_tables(
            "select * replace (coalesce(nullif(trim(category), ''), 'unknown') as category) "
            "from principals"
        ),
        "sink_plain": with_tables("select * from principals"),
        "left_join_hot_key": """
with lines as (
  select l_orderkey, l_linenumber, l_quantity, case when l_returnflag = 'A' then -1
    when l_partkey % 7 > 0 then l_partkey end as k
  from lineitem)
select lines.*, total, n as lines
from lines left join (select k, sum(l_quantity) as total, count(*) as n from lines group by k) t
  on lines.k = t.k""",
        "build_category_mart": mart,
        "build_cast_mart": cast,
        "sql_report_q1": q1,
        "sql_report_q2": q2,
        "sql_report_q3": q3,
        "sql_report_q4": q4,
        **_training_data()[1],
    }
