"""Stage compositions, registered queries and their DuckDB twins."""
