"""Structured Streaming entry points (file pickup into the batch sinks)."""
