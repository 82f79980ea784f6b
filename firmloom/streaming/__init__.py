"""The staged pipeline as Structured Streaming queries."""
