"""Spark jobs that turn raw catalogue dumps into cleaned tables, marts and reports."""
