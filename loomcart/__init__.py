"""Customer analytics over an orders star schema, written for Spark."""
