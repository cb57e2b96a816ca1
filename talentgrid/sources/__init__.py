"""Readers: topics (streaming and bounded) and tables."""
