"""Structured Streaming form of request scoring."""
