"""Structured Streaming: intake, deduplication, routing, windowed statistics and table sync."""
