"""Structured Streaming: sources, enrichment, sinks."""
