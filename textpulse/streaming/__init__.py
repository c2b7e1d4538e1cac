"""Structured Streaming runners around the plans."""
