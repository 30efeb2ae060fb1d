"""Structured Streaming pipelines: one foreachBatch per feed, at-least-once input, idempotent output."""
