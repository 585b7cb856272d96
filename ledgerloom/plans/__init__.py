"""Named queries: each binds operators to tables and has, where SQL can say it, a DuckDB twin."""
