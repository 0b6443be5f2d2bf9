"""Catalogue-shaped text tables derived from the given order tables.

Every expression is written in the SQL that Spark and the checking database share, so both start
from the same rows. All rows of the source tables are used. The values carry the dirt real dumps
have: stray quotes and backslashes, numbers that are none, odd flags, list marks, empty tokens,
missing values, and ids without a partner in the other tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_marts.operators import clean_table
from catalog_marts.sources import SILVER
from catalog_marts.sources.readers import TSV_OPTIONS

# table -> source of its rows
SOURCES = {
    "titles": "part",
    "ratings": "lineitem group by l_partkey",
    "names": "supplier",
    "principals": "lineitem",
    "akas": "lineitem join supplier on l_suppkey = s_suppkey "
            "join nation on s_nationkey = n_nationkey "
            "join region on n_regionkey = r_regionkey",
}

# table -> raw column -> expression
RAW = {
    "titles": {
        "tconst": "concat(case when p_size > 45 then 'tx' else 'tt' end, "
                  "cast(p_partkey as string))",
        "titleType": "p_type",
        "primaryTitle": "case when p_size <= 5 then concat('\"', p_name, '\" x') "
                        "when p_size <= 10 then concat('\"', p_name) "
                        "when p_size <= 15 then concat(p_name, chr(92)) "
                        "when p_size <= 20 then concat('\"', p_name, '\"') else p_name end",
        "originalTitle": "upper(p_name)",
        "isAdult": "case when p_size <= 10 then '0' when p_size <= 20 then '1' "
                   "when p_size <= 25 then '2019' when p_size <= 30 then 'zz' "
                   "when p_size <= 35 then 'true' else null end",
        "startYear": "case when p_size <= 2 then 'x' when p_size <= 4 then '99999999999' "
                     "when p_size <= 6 then ' 12 ' else cast(1980 + p_size as string) end",
        "endYear": "case when p_type = 'PROMO' then cast(1985 + p_size as string) else null end",
        "runtimeMinutes": "cast(cast(floor(p_retailprice) as int) as string)",
        "genres": "case when p_size between 7 and 11 then null when p_size = 12 then '' "
                  "when p_size between 13 and 16 then replace(p_name, ' ', ',,') "
                  "else concat('[\"', replace(p_name, ' ', '\", \"'), '\", \"', p_brand, '\"]') "
                  "end",
    },
    "ratings": {
        "tconst": "concat(case when count(*) < 24 then 'tr' else 'tt' end, "
                  "cast(l_partkey as string))",
        "averageRating": "case when min(l_discount) > 0 then null else "
                         "cast(cast(floor(sum(l_quantity) * 2 / count(*)) / 10.0 "
                         "as decimal(4, 1)) as string) end",
        "numVotes": "cast(cast(sum(l_quantity) * 10 as bigint) as string)",
    },
    "names": {
        "nconst": "concat(case when s_acctbal < 0 then 'nx' else 'nm' end, "
                  "cast(s_suppkey as string))",
        "primaryName": "s_name",
        "birthYear": "cast(1900 + s_nationkey as string)",
        "deathYear": "case when s_acctbal > 5000 then cast(1970 + s_nationkey as string) "
                     "else null end",
        "primaryProfession": "case when s_nationkey < 12 then 'actor,director' else 'writer' end",
        "knownForTitles": "concat('tt', cast(s_suppkey as string))",
    },
    "principals": {
        "tconst": "concat('tt', cast(l_partkey as string))",
        "ordering": "case when l_linenumber = 7 then null else "
                    "cast((year(l_shipdate) - 1995) * 3000 + month(l_shipdate) * 250 "
                    "+ day(l_shipdate) * 8 + l_linenumber as string) end",
        "nconst": "concat('nm', cast(l_suppkey as string))",
        "category": "case when l_returnflag = 'A' and l_linestatus = 'F' then 'actor' "
                    "when l_returnflag = 'A' then 'actress' "
                    "when l_returnflag = 'N' then 'director' "
                    "when l_linestatus = 'O' then 'producer' else 'writer' end",
        "job": "case when l_linestatus = 'O' then l_returnflag else null end",
        "characters": "case when l_returnflag = 'A' then concat('[\"Self\",\"Role ', "
                      "cast(l_linenumber as string), '\"]') else null end",
    },
    "akas": {
        "titleId": "concat('tt', cast(l_partkey as string))",
        "ordering": "cast(l_linenumber as string)",
        "title": "concat(n_name, ' cut')",
        "region": "case when r_name = 'ASIA' then null "
                  "when r_name = 'AFRICA' and l_linenumber = 1 then 'Unknown' else n_name end",
        "language": "lower(r_name)",
        "types": "case when l_returnflag = 'A' then 'original' else null end",
        "attributes": "case when l_linestatus = 'O' then 'literal title' else null end",
        "isOriginalTitle": "case when l_returnflag = 'A' then '1' when l_returnflag = 'N' "
                           "then '0' else null end",
    },
}


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw text table over the Parquet files in ``sf_dir``."""

    def load(table: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{table}.parquet")

    exprs = [F.expr(e).alias(c) for c, e in RAW[name].items()]
    if name == "titles":
        return load("part").select(*exprs)
    if name == "names":
        return load("supplier").select(*exprs)
    if name == "principals":
        return load("lineitem").select(*exprs)
    if name == "ratings":
        return load("lineitem").groupBy("l_partkey").agg(*exprs).drop("l_partkey")
    # One by one: Spark knows the size of each table, but not that of these three joined.
    rows = (
        load("lineitem")
        .join(load("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(load("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(load("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return rows.select(*exprs)


def silver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The cleaned form of :func:`raw_table`."""
    return clean_table(raw_table(spark, sf_dir, name), SILVER[name])


def write_dump(raw: DataFrame, path: str) -> None:
    """Write a raw table the way the dumps come: header, tabs, no quoting, text untouched."""
    raw.write.options(
        **TSV_OPTIONS, emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def raw_sql(name: str) -> str:
    """The raw table as plain SQL, for the check."""
    columns = ", ".join(f"{e} as {c}" for c, e in RAW[name].items())
    return f"select {columns} from {SOURCES[name]}"


def _clean_sql(raw: str, type_name: str, strip: str) -> str:
    if type_name == "boolean":
        return (f"coalesce(try_cast(try_cast({raw} as int) as boolean), "
                f"try_cast({raw} as boolean))")
    text = raw if type_name == "string" else f"try_cast({raw} as {type_name})"
    for mark in strip:
        text = f"replace({text}, '{mark}', '')"
    return text


def silver_sql(name: str) -> str:
    """The cleaned table as plain SQL over ``raw_<name>``, for the check."""
    columns = ", ".join(
        f"{_clean_sql(f.raw, f.type, f.strip)} as {f.name}" for f in SILVER[name].fields
    )
    return f"select {columns} from raw_{name}"


def with_tables(body: str) -> str:
    """``body`` with every raw and cleaned table defined in front of it."""
    ctes = [f"raw_{n} as ({raw_sql(n)})" for n in RAW]
    ctes += [f"{n} as ({silver_sql(n)})" for n in RAW]
    return "with " + ",\n".join(ctes) + "\n" + body
