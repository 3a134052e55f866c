"""What each metric compares, computed once per article and never per pair.

A feature table has exactly one row per article that the metric can score; source rows that repeat an
article are reduced by a fixed rule, before the shuffle where they meet. An article without a row
leaves its pairs unscored; a row with a NULL value scores them 0.0. Rows without an article id, and
approvals without an id of their own, are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echowire.functions.texts import combine_text, content_hash
from echowire.functions.urls import with_canonical_url
from echowire.functions.vectors import Encoder, encoded
from echowire.session import small_batches


def url_features(articles: DataFrame) -> DataFrame:
    """articleId, key: the hash of the canonical URL, which unlike the URL has a fixed size.

    Of several URLs for one article the lowest hash counts.
    """
    named = articles.where("id IS NOT NULL").select(F.col("id").alias("articleId"), "url")
    hashed = with_canonical_url(named).select("articleId", F.sha2("canonicalUrl", 256).alias("key"))
    return hashed.groupBy("articleId").agg(F.min("key").alias("key"))


def content_features(approved: DataFrame, min_chars: int = 0) -> DataFrame:
    """articleId, key: the content hash of the article's approval with the lowest id.

    Texts are hashed where they are read, so only hashes reach the shuffle that picks one
    approval per article. `min_chars` > 0 gives articles with less text than that, such as
    those without any ASCII letter or digit, no key: they then match nothing.
    """
    key = content_hash("headline", "text")
    if min_chars > 0:
        letters = F.length(F.regexp_replace(F.lower(F.concat_ws("", "headline", "text")), "[^a-z0-9]+", ""))
        key = F.when(letters >= min_chars, key)
    hashed = _counted(approved).select("articleId", "id", F.struct(key.alias("key")).alias("value"))
    first = hashed.groupBy("articleId").agg(F.min_by("value", "id").alias("value"))
    return first.select("articleId", "value.key")


def _counted(approved: DataFrame) -> DataFrame:
    """Approvals that can be ranked."""
    return approved.where("articleId IS NOT NULL AND id IS NOT NULL")


def first_approvals(approved: DataFrame) -> DataFrame:
    """The approval with the lowest id of each article, chosen on the two id columns alone.

    The result holds whole texts, so this join shuffles them; a table bucketed by article avoids that.
    """
    approved = _counted(approved)
    lowest = approved.groupBy("articleId").agg(F.min("id").alias("id"))
    return approved.join(lowest, ["articleId", "id"], "left_semi")


def article_texts(approved: DataFrame) -> DataFrame:
    """articleId, combinedText: what an encoder gets to see."""
    return first_approvals(approved).select(
        "articleId", combine_text("headline", "text").alias("combinedText")
    )


def encode_articles(
    approved: DataFrame, load_encoder: Callable[[], Encoder], dimension: int
) -> DataFrame:
    """articleId, embedding from a user-supplied encoder. Write the result before using it
    more than once: encoding is by far the dearest step.

    Texts are encoded where they are read, superseded approvals included, and one approval per
    article is picked afterwards: vectors of a fixed width are shuffled, texts never.
    """
    small_batches(approved.sparkSession)
    texts = _counted(approved).select("articleId", "id", combine_text("headline", "text").alias("text"))
    vectors = texts.select("articleId", "id", encoded(F.col("text"), load_encoder, dimension).alias("embedding"))
    return vectors.groupBy("articleId").agg(F.min_by("embedding", "id").alias("embedding"))


def vector_features(vectors: DataFrame) -> DataFrame:
    """articleId, embedding; of several vectors for one article the one with the lowest hash counts."""
    held = vectors.where("articleId IS NOT NULL").select("articleId", F.struct("embedding").alias("value"))
    one = held.groupBy("articleId").agg(F.min_by("value", F.xxhash64("value")).alias("value"))
    return one.select("articleId", "value.embedding")
