"""Continuous intake of id files."""
