"""Registered queries (Spark) and their DuckDB oracles."""
