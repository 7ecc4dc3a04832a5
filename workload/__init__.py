"""Registered queries: Spark callables with, where SQL can express them, a DuckDB equivalent."""
