"""Readers and writers of the campaign's files."""
