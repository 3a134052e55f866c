"""Figures on rating rows. Each report is one row from one pass over the ratings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echowire.functions.numbers import floor_percent, rounded_percent
from echowire.functions.urls import with_canonical_url
from echowire.operators.figures import (
    content_percentages,
    embedding_percentages,
    one_row,
    url_percentages,
)
from echowire.operators.ratings import HIGH_SIMILARITY, completed, with_both
from echowire.sources.tables import PAIR


def _progress(metric: str, prefix: str) -> list[Column]:
    return [
        F.count(metric).alias(f"{prefix}_completed"),
        F.count_if(F.col(metric).isNull()).alias(f"{prefix}_pending"),
    ]


def _total() -> Column:
    return F.count("*").alias("total_pairs")


def _articles() -> list[Column]:
    return [
        F.count_distinct("articleIdNew").alias("unique_new_articles"),
        F.count_distinct("articleIdApproved").alias("unique_approved_articles"),
    ]


def _url() -> list[Column]:
    return [*_progress("urlCheck", "url_check"), F.count_if(F.col("urlCheck") == 1).alias("matching_urls")]


def _content() -> list[Column]:
    return [
        *_progress("contentHash", "content_hash"),
        F.count_if(F.col("contentHash") == 1).alias("matching_content"),
    ]


def _embedding(threshold: float) -> list[Column]:
    return [
        *_progress("embeddingSearch", "embedding_search"),
        F.count_if(F.col("embeddingSearch") > threshold).alias("high_similarity_pairs"),
        F.coalesce(F.avg("embeddingSearch"), F.lit(0.0)).alias("avg_similarity_score"),
    ]


def pair_stats(ratings: DataFrame) -> DataFrame:
    return ratings.agg(_total(), *_articles())


def url_stats(ratings: DataFrame) -> DataFrame:
    return ratings.agg(_total(), *_url())


def url_status(ratings: DataFrame) -> DataFrame:
    return url_stats(ratings).withColumns(url_percentages())


def content_stats(ratings: DataFrame) -> DataFrame:
    return ratings.agg(_total(), *_content())


def content_status(ratings: DataFrame) -> DataFrame:
    return content_stats(ratings).withColumns(content_percentages())


def embedding_stats(ratings: DataFrame, threshold: float = HIGH_SIMILARITY) -> DataFrame:
    return ratings.agg(_total(), *_embedding(threshold))


def embedding_status(ratings: DataFrame, threshold: float = HIGH_SIMILARITY) -> DataFrame:
    return embedding_stats(ratings, threshold).withColumns(embedding_percentages())


def approved_count(approved: DataFrame) -> DataFrame:
    return approved.agg(F.count_distinct("articleId").alias("approved_articles"))


def status_report(
    ratings: DataFrame, approved: DataFrame, threshold: float = HIGH_SIMILARITY
) -> DataFrame:
    """Every progress figure of the ratings and the number of approved articles."""
    figures = ratings.agg(
        _total(), *_articles(), *_url(), *_content(), *_embedding(threshold)
    )
    row = one_row(figures, approved_count(approved))
    return row.withColumns({
        "csv_articles_loaded": F.col("unique_new_articles"),
        **url_percentages(),
        **content_percentages(),
        **embedding_percentages(),
    })


def url_run_result(scored: DataFrame) -> DataFrame:
    """Pairs a URL pass scored, matches among them and the match rate in percent."""
    result = scored.agg(
        F.count_if("scoredNow").alias("processed_pairs"),
        F.count_if(F.col("scoredNow") & (F.col("urlCheck") == 1)).alias("url_matches_found"),
    )
    return result.withColumn(
        "match_rate", rounded_percent(F.col("url_matches_found"), F.col("processed_pairs"), 2)
    )


def content_run_result(scored: DataFrame) -> DataFrame:
    """Pairs a content pass scored, by outcome, and the match rate in whole percent."""
    now, failed = F.col("scoredNow"), F.col("failedNow")
    result = scored.agg(
        F.count_if(now).alias("processed"),
        F.count_if(now & (F.col("contentHash") == 1)).alias("matches"),
        F.count_if(now & ~failed & (F.col("contentHash") == 0)).alias("non_matches"),
        F.count_if(failed).alias("errors"),
    )
    return result.withColumn("match_rate", floor_percent(F.col("matches"), F.col("processed")))


def embedding_run_result(scored: DataFrame, threshold: float = HIGH_SIMILARITY) -> DataFrame:
    """Pairs an embedding pass scored, high ones, failures, and the mean without failures."""
    now, failed, score = F.col("scoredNow"), F.col("failedNow"), F.col("embeddingSearch")
    result = scored.agg(
        F.count_if(now).alias("total_processed"),
        F.count_if(now & (score > threshold)).alias("total_high_similarity"),
        F.coalesce(F.avg(F.when(now & ~failed, score)), F.lit(0.0)).alias("overall_avg_similarity"),
        F.count_if(failed).alias("total_errors"),
    )
    return result.withColumn(
        "high_percentage", floor_percent(F.col("total_high_similarity"), F.col("total_processed"))
    )


def best_scored_urls(ratings: DataFrame, articles: DataFrame, limit: int = 10) -> DataFrame:
    """The `limit` best-scored pairs with both URLs as given and in canonical form.

    Pairs whose article is missing are left out before the cut, on ids alone; the URLs are
    joined to the `limit` rows that remain.
    """
    ranked = completed(ratings, "urlCheck").select(*PAIR, "urlCheck")
    ranked = with_both(ranked, articles.select(F.col("id").alias("articleId")))
    top = ranked.orderBy(F.desc("urlCheck"), *PAIR).limit(limit)
    for role in ("New", "Approved"):
        side = articles.select(F.col("id").alias(f"articleId{role}"), F.col("url").alias(f"url{role}"))
        top = side.join(top, f"articleId{role}")
        top = with_canonical_url(top, f"url{role}", f"canonical{role}")
    return top.select(
        *PAIR, "urlCheck", "urlNew", "urlApproved", "canonicalNew", "canonicalApproved"
    ).orderBy(F.desc("urlCheck"), *PAIR)
