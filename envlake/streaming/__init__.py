"""The same merges fed by Structured Streaming."""
