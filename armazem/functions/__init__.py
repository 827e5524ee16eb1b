"""Column functions: built-in expressions only, no Python UDF."""
