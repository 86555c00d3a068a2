"""Structured Streaming front end for incremental monthly loads."""
