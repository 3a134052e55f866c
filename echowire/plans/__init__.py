"""Whole runs and the figures they report."""
