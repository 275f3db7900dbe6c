"""Structured Streaming: framed trade messages into a keyed table."""
