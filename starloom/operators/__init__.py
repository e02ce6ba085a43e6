"""Reusable DataFrame operators: key conflicts, ids, joins, loads and quality checks."""
