"""Reading files: JSON lines, CSV, Parquet, bulk staging loads and code-list text."""
