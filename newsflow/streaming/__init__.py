"""The 15-minute feed as Structured Streaming."""
