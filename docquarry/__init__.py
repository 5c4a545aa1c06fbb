"""Document search, aggregation and maintenance as plain Spark DataFrame functions."""
