"""Whole jobs: cleaned layer, marts, reports, publishing."""

from .contracts import check_keys, raise_on_broken_keys
from .layers import build_gold, build_silver
from .marts import cast_mart, category_mart
from .publish import open_published, publish, raise_on_failure
from .reports import report_q1, report_q2, report_q3, report_q4
from .stored import open_report, store_report
from .versions import open_version, publish_changes, verify_version

__all__ = [
    "build_gold", "build_silver", "cast_mart", "category_mart", "check_keys", "open_published", "open_report",
    "open_version",
    "publish", "publish_changes", "raise_on_broken_keys",
    "raise_on_failure", "report_q1", "report_q2", "report_q3",
    "report_q4", "store_report", "verify_version",
]
