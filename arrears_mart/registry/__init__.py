"""Queries over the test tables, and the same rules in plain SQL."""
