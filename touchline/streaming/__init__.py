"""Structured Streaming ingestion of raw events."""
