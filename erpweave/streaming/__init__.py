"""Structured Streaming: ingestion, typed streams, deduplication, upserts."""
