"""Column functions built from native Spark expressions."""
