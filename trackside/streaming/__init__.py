"""Structured Streaming: continuous ingest, late-day replacement, dedup, counters."""
