"""Independent DuckDB statements of every registered query (the correctness oracle)."""
