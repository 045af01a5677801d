"""Structured Streaming jobs over the operators."""
