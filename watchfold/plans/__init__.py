"""End-to-end plans: the registry of named queries, the DuckDB oracle and the warehouse."""
