"""Query registry, full-refresh job and the DuckDB oracle."""
