"""The same layers as Structured Streaming queries."""
