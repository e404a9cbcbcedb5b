"""Flows (scoring, training, monitoring), registered queries and their DuckDB oracle."""
