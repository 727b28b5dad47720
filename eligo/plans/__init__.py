"""Query plans over the shared test tables (Spark side and DuckDB oracle side)."""
