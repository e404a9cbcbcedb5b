"""Structured Streaming form of the inference profile."""
