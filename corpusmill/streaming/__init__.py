"""Pipelines over unbounded inputs with Structured Streaming."""
