"""Debt-collection data mart as PySpark DataFrame operators."""
