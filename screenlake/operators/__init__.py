"""Operators: joins, aggregates, windows and packing over domain tables."""
