"""Structured Streaming jobs for the movement feed."""
