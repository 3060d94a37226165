"""Event-stream counting and ranking as Spark DataFrame jobs."""
