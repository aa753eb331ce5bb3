"""Structured Streaming jobs over a landing folder."""
