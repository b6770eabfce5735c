"""Structured Streaming jobs (collector and overlap dedup)."""
