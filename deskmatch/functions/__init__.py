"""Column to column helpers built from Spark functions."""
