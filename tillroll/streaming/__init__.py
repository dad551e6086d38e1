"""Loading newly landed files with Structured Streaming."""
