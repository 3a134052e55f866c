"""Derived figures shared by the reports on rating rows and on implied pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echowire.functions.numbers import floor_percent, rounded_percent


def one_row(*frames: DataFrame) -> DataFrame:
    """Several one-row frames with different columns as one row, without a product join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*(F.max(c).alias(c) for c in stacked.columns))


def url_percentages() -> dict[str, Column]:
    return {
        "completion_percentage": rounded_percent(F.col("url_check_completed"), F.col("total_pairs"), 1),
        "match_percentage": rounded_percent(F.col("matching_urls"), F.col("url_check_completed"), 1),
    }


def content_percentages() -> dict[str, Column]:
    return {
        "content_completion_percentage": floor_percent(F.col("content_hash_completed"), F.col("total_pairs")),
        "content_match_percentage": floor_percent(F.col("matching_content"), F.col("content_hash_completed")),
    }


def embedding_percentages() -> dict[str, Column]:
    return {
        "embedding_completion_percentage": floor_percent(
            F.col("embedding_search_completed"), F.col("total_pairs")
        ),
    }
