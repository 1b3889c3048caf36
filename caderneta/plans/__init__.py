"""Whole-run plans: the pipeline and its audit table."""
