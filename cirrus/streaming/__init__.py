"""Structured Streaming versions of the analytics."""
