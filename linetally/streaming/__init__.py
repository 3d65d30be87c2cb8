"""Structured Streaming form of the text profile."""
