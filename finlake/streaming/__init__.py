"""Structured Streaming ingest of JSON events with keyed micro-batch upserts."""
