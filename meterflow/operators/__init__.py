"""Operators over readings, windows and marts."""
