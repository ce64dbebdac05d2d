"""Sinks: partitioned lake, NDJSON day files, topic publish."""
