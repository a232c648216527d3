"""Structured Streaming: enrichment, windows, sinks, lifecycle."""
