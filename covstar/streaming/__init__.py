"""Structured Streaming forms of the incremental load and daily stats."""
