"""Structured Streaming around the batch plans."""
