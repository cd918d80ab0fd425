"""Model graph, marts, serving queries, prototype, month job, query catalog and DuckDB oracles."""
