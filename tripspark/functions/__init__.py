"""Column expressions: no function in here starts a Spark job."""
