"""Composite plans and the catalogue of queries."""
