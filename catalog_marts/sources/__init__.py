"""Table specifications, readers and writers."""

from .buckets import bucket_sizes, open_bucketed, write_bucketed
from .folders import claim, names_in, remove_folder
from .readers import read_table, read_tsv, register_views, require_tables
from .specs import AKAS, GOLD_SCHEMAS, NAMES, PRINCIPALS, RATINGS, SILVER, TITLES, Field, TableSpec
from .writers import scratch_copy, scratch_dir, scratch_scope, write_table

__all__ = [
    "AKAS", "GOLD_SCHEMAS", "NAMES", "PRINCIPALS", "RATINGS", "SILVER", "TITLES",
    "Field", "TableSpec",
    "bucket_sizes", "claim", "names_in", "open_bucketed", "read_table", "read_tsv", "register_views", "remove_folder",
    "require_tables", "scratch_copy", "scratch_dir", "scratch_scope", "write_bucketed",
    "write_table",
]
