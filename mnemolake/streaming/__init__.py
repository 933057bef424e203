"""Structured Streaming forms of the mutations."""
