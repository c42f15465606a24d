"""Report analytics on Spark."""
