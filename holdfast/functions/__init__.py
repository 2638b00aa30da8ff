"""Column expressions: all built on Spark's own functions, no Python row code."""
