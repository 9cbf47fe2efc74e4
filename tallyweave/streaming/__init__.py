"""Structured Streaming."""
