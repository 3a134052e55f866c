"""Duplicate-article analytics as Spark jobs."""
