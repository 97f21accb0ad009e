"""Mediated relations, the query catalog and the DuckDB oracle SQL."""
