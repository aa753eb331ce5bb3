"""Landing formats and table writers."""
