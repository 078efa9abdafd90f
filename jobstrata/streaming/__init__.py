"""Structured Streaming over the batch functions."""
