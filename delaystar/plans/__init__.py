"""Query registry (Spark plans) and their DuckDB twins."""
