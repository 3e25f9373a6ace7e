"""Composite jobs, mapping views and the query registry."""
