"""Casts, upserts and writers."""
