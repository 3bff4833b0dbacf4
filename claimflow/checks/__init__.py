"""Oracle SQL (DuckDB dialect) for the correctness gate."""
