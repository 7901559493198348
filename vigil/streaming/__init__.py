"""Structured Streaming flows, listener capture and per-key state."""
