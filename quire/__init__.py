"""Document-archive analytics on Spark."""
