"""Column-level building blocks; nothing here runs a Spark job."""
