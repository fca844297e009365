"""Column-valued helpers built from Spark SQL built-in functions."""
