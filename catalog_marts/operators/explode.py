"""Delimited text column -> one row per token."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_marts.functions import non_blank


def explode_category(
    df: DataFrame, column: str = "genres", sep: str = ",", default: str = "unknown"
) -> DataFrame:
    """Replace ``column`` by its tokens, one row each; no row is lost.

    A NULL list keeps its row, and a NULL or blank token becomes ``default`` (a blank token
    would otherwise end up in the nameless partition of a partitioned table).
    """
    tokens = F.split(F.col(column), re.escape(sep))
    exploded = df.withColumn(column, F.explode_outer(tokens))
    return exploded.withColumn(column, non_blank(F.col(column), default))
