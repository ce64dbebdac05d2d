"""Operators: feed decoding, flattening, dedup, views, quality and analytics."""
