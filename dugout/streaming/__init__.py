"""Structured Streaming jobs over landed payload files."""
