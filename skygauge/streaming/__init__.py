"""Structured Streaming jobs over sensor readings."""
