"""Structured Streaming jobs with a batch twin each."""
