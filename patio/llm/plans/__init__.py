"""Queries by family, with their DuckDB twins."""
