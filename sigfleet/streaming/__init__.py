"""Structured Streaming monitors."""
