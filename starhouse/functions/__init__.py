"""Column expressions: every function takes columns and returns a column, none uses a UDF."""
