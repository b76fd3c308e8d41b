"""Whole comparisons: reconcile two tables, report on them, validate a pipeline."""
