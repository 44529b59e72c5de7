"""Structured Streaming jobs for the incremental patterns."""
