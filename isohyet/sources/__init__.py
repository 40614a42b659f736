"""Readers that bring source formats to tidy canonical columns."""
