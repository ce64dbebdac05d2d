"""Jobs: batch ingest (frames -> lake) and the daily load (lake -> table)."""
