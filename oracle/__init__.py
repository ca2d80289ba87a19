"""DuckDB oracle for the driver queries (test scaffolding, not library code)."""
