"""Column functions, all on Spark built-ins."""
