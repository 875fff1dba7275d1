"""The same operations on Structured Streaming."""
