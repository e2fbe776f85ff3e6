"""End-to-end queries over the supplied tables, each with its DuckDB statement."""
