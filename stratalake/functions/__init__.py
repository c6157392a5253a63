"""Column expressions; all stay inside Spark's own functions."""
