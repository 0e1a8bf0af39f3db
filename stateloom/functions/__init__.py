"""Column expressions and aggregates, all built from Spark's own functions."""
