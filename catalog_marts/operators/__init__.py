"""Reusable DataFrame -> DataFrame operators."""

from .clean import clean_table
from .explode import explode_category
from .joins import left_join_spread
from .rank import dense_rank_spread, top_n_per_group
from .ratings import rating_totals, weighted_rating
from .rejects import clean_with_rejects
from .rollups import crew_rollup, region_rollup
from .substrings import build_substring_index, search_substrings

__all__ = [
    "build_substring_index", "clean_table", "clean_with_rejects", "crew_rollup", "dense_rank_spread", "explode_category",
    "left_join_spread", "rating_totals", "region_rollup", "search_substrings", "top_n_per_group", "weighted_rating",
]
