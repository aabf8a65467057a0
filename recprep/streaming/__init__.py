"""Structured Streaming over example files."""
