"""Column expressions shared by the operators."""

from .columns import bayes_score, contains_any, lenient_cast, non_blank, sort_key, strip_chars

__all__ = ["bayes_score", "contains_any", "lenient_cast", "non_blank", "sort_key", "strip_chars"]
