"""Structured Streaming flows: change feeds and the event-driven pipelines."""
