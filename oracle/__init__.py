"""DuckDB statements that answer the registered queries a second, naive way."""
