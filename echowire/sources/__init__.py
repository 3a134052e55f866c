"""Inputs and outputs: id files, article tables, rating snapshots."""
