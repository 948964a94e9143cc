"""Job plans: the reference's jobs wired from operators, and the catalog of
driver queries with their DuckDB oracle SQL."""
