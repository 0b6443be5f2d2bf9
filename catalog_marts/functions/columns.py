"""Column -> Column helpers. Built-in expressions only, so they stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_cast(col: Column, type_name: str) -> Column:
    """Cast text to ``type_name``; text that does not fit becomes NULL instead of failing.

    A boolean accepts any whole number (zero is false, everything else true) as well as the
    usual words, whatever the other rows of the column hold.
    """
    if type_name == "string":
        return col
    if type_name == "boolean":
        as_number = col.try_cast("int").try_cast("boolean")
        return F.coalesce(as_number, col.try_cast("boolean"))
    return col.try_cast(type_name)


def strip_chars(col: Column, chars: str) -> Column:
    """Remove every occurrence of each of ``chars``."""
    return F.translate(col, chars, "")


def non_blank(col: Column, default: str) -> Column:
    """Trimmed text, or ``default`` when it is NULL or nothing but spaces."""
    return F.coalesce(F.nullif(F.trim(col), F.lit("")), F.lit(default))


def contains_any(col: Column, needles: Sequence[str]) -> Column:
    """Case-insensitive "contains one of these" over the whole text."""
    lowered = F.lower(col)
    return reduce(lambda a, b: a | b, [lowered.contains(n.lower()) for n in needles])


def bayes_score(rating: Column, votes: Column, mean: Column, prior_votes: float) -> Column:
    """Rating pulled towards ``mean`` with the weight of ``prior_votes`` extra votes."""
    v = votes.cast("double")
    m = F.lit(float(prior_votes))
    own = F.try_divide(v, v + m)
    prior = F.try_divide(m, v + m)
    return own * rating + prior * mean


def sort_key(key: str) -> Column:
    """``"x"`` or ``"x desc"`` as a sort column; NULL is first ascending and last descending."""
    name, _, direction = key.partition(" ")
    descending = direction.strip().lower() == "desc"
    return F.col(name).desc_nulls_last() if descending else F.col(name).asc_nulls_first()
