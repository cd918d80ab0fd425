"""The registered queries: feeds derived from the given tables, query builders, and their DuckDB SQL."""
