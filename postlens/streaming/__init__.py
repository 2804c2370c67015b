"""Structured Streaming jobs and per-batch sinks."""
