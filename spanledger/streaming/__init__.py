"""Structured Streaming forms of the recurring loads."""
