"""Structured Streaming ingestion into keyed tables."""
