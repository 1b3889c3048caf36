"""Registered queries over the given tables, and their check SQL."""
