"""Sources: feed frames, topic records, the lake, NDJSON files, the stand-in."""
