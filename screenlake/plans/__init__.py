"""Whole reports and the end-to-end screen, composed of operators."""
