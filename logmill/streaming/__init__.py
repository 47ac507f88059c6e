"""The same document path on Structured Streaming."""
