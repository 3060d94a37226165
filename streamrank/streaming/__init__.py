"""Running the plans as Structured Streaming queries."""
