"""Whole passes: read one snapshot, compute, write the next.

Feature tables are written before they are joined. Both sides of a pair and the hot keys of
each read them, and hashing texts or encoding them once is what a pass should cost.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echowire.functions.vectors import Encoder
from echowire.operators import features as made
from echowire.operators.ratings import (
    article_values,
    fill_pending,
    insert_or_ignore,
    new_ratings,
    pending_scores,
    score_pending,
    with_scores,
)
from echowire.session import stored
from echowire.sources.snapshots import BUCKETS, bucketed, write_bucketed
from echowire.sources.tables import PAIR, write_snapshot


def load_pairs(ratings: DataFrame, pairs: DataFrame, out: str, run_ts: datetime) -> DataFrame:
    """Next snapshot with the given pairs added where they are missing."""
    return write_snapshot(insert_or_ignore(ratings, pairs, run_ts), out)


def metric_pass(
    ratings: DataFrame,
    metric: str,
    features: DataFrame,
    out: str,
    run_ts: datetime,
    recompute: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Next snapshot with one metric filled from a feature table.

    The snapshot also holds the flags `scoredNow` and `failedNow` of this pass, from which the
    run results are counted; `read_ratings` leaves them out.
    """
    scored = score_pending(ratings, metric, features, run_ts, recompute, limit)
    return write_snapshot(scored, out)


def fill_pass(ratings: DataFrame, features: dict[str, DataFrame], out: str, run_ts: datetime) -> DataFrame:
    """Next snapshot with the empty cells of several metrics filled from their feature tables, in one pass over the pairs."""
    values = stored(article_values(features), "article-values")
    return write_snapshot(fill_pending(ratings, values, run_ts), out)


def bucketed_load(ratings: DataFrame, pairs: DataFrame, out: str, run_ts: datetime, buckets: int = BUCKETS) -> DataFrame:
    """`load_pairs` from one bucketed snapshot to the next: only the given pairs are shuffled."""
    return write_bucketed(bucketed_insert(ratings, pairs, run_ts, buckets), out, buckets)


def bucketed_insert(ratings: DataFrame, pairs: DataFrame, run_ts: datetime, buckets: int = BUCKETS) -> DataFrame:
    """`insert_or_ignore` on a bucketed snapshot; repeated pairs are reduced before they are sent to the buckets."""
    given = stored(pairs.select(*PAIR).distinct(), "given-pairs")
    return ratings.unionByName(new_ratings(ratings.hint("shuffle_merge"), bucketed(given, buckets), run_ts))


def bucketed_fill(
    ratings: DataFrame, features: dict[str, DataFrame], out: str, run_ts: datetime, buckets: int = BUCKETS
) -> DataFrame:
    """`fill_pass` from one bucketed snapshot to the next.

    The ids of pairs with an empty cell travel to their articles' values, and scores back to the buckets; the rows of the
    snapshot stay where they are.
    """
    values = stored(article_values(features), "article-values")
    scores = stored(pending_scores(ratings, values), "pair-scores")
    return write_bucketed(bucketed_scores(ratings, scores, list(features), run_ts), out, buckets)


def bucketed_scores(ratings: DataFrame, scores: DataFrame, metrics: list[str], run_ts: datetime) -> DataFrame:
    """Rows of a bucketed snapshot with `scores`, see `pending_scores`, in their empty cells."""
    return with_scores(ratings.join(scores.hint("shuffle_merge"), list(PAIR), "left"), metrics, run_ts)


def url_pass(ratings: DataFrame, articles: DataFrame, out: str, run_ts: datetime, **how) -> DataFrame:
    features = stored(made.url_features(articles), "url-features")
    return metric_pass(ratings, "urlCheck", features, out, run_ts, **how)


def content_pass(
    ratings: DataFrame, approved: DataFrame, out: str, run_ts: datetime, min_chars: int = 0, **how
) -> DataFrame:
    features = stored(made.content_features(approved, min_chars), "content-features")
    return metric_pass(ratings, "contentHash", features, out, run_ts, **how)


def embedding_pass(
    ratings: DataFrame, vectors: DataFrame, out: str, run_ts: datetime, **how
) -> DataFrame:
    """Vectors come as a stored table; `text_vectors` makes one from texts."""
    return metric_pass(ratings, "embeddingSearch", made.vector_features(vectors), out, run_ts, **how)


def text_vectors(
    approved: DataFrame, load_encoder: Callable[[], Encoder], dimension: int, out: str
) -> DataFrame:
    """A vector table encoded from approved texts and written."""
    return write_snapshot(made.encode_articles(approved, load_encoder, dimension), out)


def extend_features(
    existing: DataFrame, source: DataFrame, source_id: str, make: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """A feature table plus the articles of `source` it lacks; nothing is computed twice.

    This is what makes a pass on implied pairs restartable: a pair is pending while either
    article has no feature row.
    """
    known = existing.select(F.col("articleId").alias(source_id))
    return existing.unionByName(make(source.join(known, source_id, "left_anti")))
