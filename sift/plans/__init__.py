"""Contract queries (plans.queries) and their DuckDB SQL (plans.oracle)."""
