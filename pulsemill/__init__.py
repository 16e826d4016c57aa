"""Wearable-telemetry analytics on Spark: document decoding, keyed merges, file sets, chunked tables."""
