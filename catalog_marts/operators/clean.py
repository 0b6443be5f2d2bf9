"""Raw text table -> typed, renamed, cleaned table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_marts.functions import lenient_cast, strip_chars
from catalog_marts.sources.specs import TableSpec


def clean_table(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Apply ``spec`` in a single projection: pick, cast leniently, strip list marks, rename.

    One ``select`` lets the scan read only the listed columns, and keeps analysis cheap however
    many columns there are.
    """
    columns = []
    for field in spec.fields:
        col = lenient_cast(F.col(field.raw), field.type)
        if field.strip:
            col = strip_chars(col, field.strip)
        columns.append(col.alias(field.name))
    return raw.select(*columns)
