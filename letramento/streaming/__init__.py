"""Structured Streaming ingestion of pupil events."""
