"""Structured Streaming jobs: scoring with collection, and daily profiles."""
