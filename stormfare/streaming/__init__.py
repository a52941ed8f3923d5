"""Structured Streaming over the weather feed."""
