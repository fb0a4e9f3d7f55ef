"""Continuous versions of the roll-ups, as Structured Streaming queries."""
