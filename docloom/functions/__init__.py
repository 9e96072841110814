"""Column functions: every one takes columns and returns a column, built from Spark built-ins."""
