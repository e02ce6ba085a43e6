"""Star-schema data lakes on PySpark: sources, key-conflict loads, quality gates and reports."""
