"""Whole jobs: the hourly load and the registered queries."""
