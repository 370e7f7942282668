"""Structured Streaming: running queries, watermarks, keyed state."""
