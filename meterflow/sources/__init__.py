"""Readings from tables, raw JSON archives and legacy files."""
