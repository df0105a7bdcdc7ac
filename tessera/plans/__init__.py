"""Registered queries (key -> Spark plan, key -> DuckDB oracle SQL) over the
fixture stand-ins; ``registry.load_all`` imports them."""
