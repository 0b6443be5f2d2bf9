"""Operators for large-scale training-data preparation; nothing outside imports this package."""
