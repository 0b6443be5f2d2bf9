"""What each raw dump looks like and what its cleaned table is called.

A :class:`TableSpec` is data only; :func:`catalog_marts.operators.clean.clean_table` applies it.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Field:
    raw: str
    name: str
    type: str
    strip: str = ""  # characters removed from the text


@dataclass(frozen=True)
class TableSpec:
    name: str
    file: str
    fields: tuple[Field, ...]
    sort_by: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()

    @property
    def raw_columns(self) -> list[str]:
        return [f.raw for f in self.fields]

    @property
    def schema(self) -> str:
        """Schema of the cleaned table, in the form readers accept."""
        return ", ".join(f"{f.name} {f.type}" for f in self.fields)


# File names, raw headers, cleaned names, types and sort keys of the catalogue dumps.
LIST_MARKS = '[]"'
LIST_MARKS_AND_SPACE = '[]" '

NAMES = TableSpec(
    name="names",
    file="name.basics.tsv",
    fields=(
        Field("nconst", "name_id", "string"),
        Field("primaryName", "primary_name", "string"),
        Field("birthYear", "birth_year", "int"),
        Field("deathYear", "death_year", "int"),
        Field("primaryProfession", "primary_profession", "string"),
        Field("knownForTitles", "known_for_titles", "string"),
    ),
    sort_by=("name_id",),
)

PRINCIPALS = TableSpec(
    name="principals",
    file="title.principals.tsv",
    fields=(
        Field("tconst", "title_id", "string"),
        Field("ordering", "ordering", "int"),
        Field("nconst", "name_id", "string"),
        Field("category", "category", "string"),
        Field("job", "job", "string"),
        Field("characters", "characters", "string", strip=LIST_MARKS),
    ),
    sort_by=("title_id", "name_id"),
)

AKAS = TableSpec(
    name="akas",
    file="title.akas.tsv",
    fields=(
        Field("titleId", "title_id", "string"),
        Field("ordering", "ordering", "int"),
        Field("title", "title", "string"),
        Field("region", "region", "string"),
        Field("language", "language", "string"),
        Field("types", "types", "string"),
        Field("attributes", "attributes", "string"),
        Field("isOriginalTitle", "is_original_title", "boolean"),
    ),
    sort_by=("title_id", "region"),
)

TITLES = TableSpec(
    name="titles",
    file="title.basics.tsv",
    fields=(
        Field("tconst", "title_id", "string"),
        Field("titleType", "title_type", "string"),
        Field("primaryTitle", "primary_title", "string"),
        Field("originalTitle", "original_title", "string"),
        Field("isAdult", "is_adult", "boolean"),
        Field("startYear", "start_year", "int"),
        Field("endYear", "end_year", "int"),
        Field("runtimeMinutes", "runtime_minutes", "int"),
        Field("genres", "genres", "string", strip=LIST_MARKS_AND_SPACE),
    ),
    sort_by=("title_id", "title_type", "start_year", "end_year"),
)

RATINGS = TableSpec(
    name="ratings",
    file="title.ratings.tsv",
    fields=(
        Field("tconst", "title_id", "string"),
        Field("averageRating", "average_rating", "float"),
        Field("numVotes", "num_votes", "int"),
    ),
    sort_by=("title_id",),
)

SILVER = {s.name: s for s in (NAMES, PRINCIPALS, AKAS, TITLES, RATINGS)}

# Declared so that partition values read back as text, never as inferred numbers or dates.
GOLD_SCHEMAS = {
    "category_wise_movies": (
        "title_id string, title_type string, primary_title string, original_title string, "
        "is_adult boolean, start_year int, end_year int, runtime_minutes int, genres string, "
        "average_rating float, num_votes int, weighted_rating double, actors string, "
        "directors string, producers string, regions string, region_count bigint"
    ),
    "top_category_wise_cast": (
        "name_id string, primary_name string, category string, birth_year int, death_year int, "
        "avg_weighted_rating double, total_movies bigint, rank int"
    ),
}
