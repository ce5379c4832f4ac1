"""Structured Streaming operators and sinks."""
