"""Readers and page extraction."""
