"""Incremental runs: scenes or events that arrive over time, by Structured Streaming."""
