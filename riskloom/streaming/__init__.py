"""The batch operators on Structured Streaming."""
