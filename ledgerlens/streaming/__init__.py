"""Structured Streaming versions of the aggregate jobs."""
