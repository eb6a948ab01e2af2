"""Structured Streaming jobs over raw answers and inferences."""
