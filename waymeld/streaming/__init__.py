"""Change feeds as Structured Streaming."""
