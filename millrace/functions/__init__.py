"""Column expressions built from Spark's own functions."""
