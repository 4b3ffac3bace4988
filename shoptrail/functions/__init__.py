"""Column expressions: all built from Spark's own functions."""
