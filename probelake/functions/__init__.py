"""Column functions; all are built-in Spark expressions."""
