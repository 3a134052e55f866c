"""Exact metrics on the pairs a roster implies, without writing the pairs.

Two articles match when their keys are equal. All figures come from counts per key and load,
and the matches themselves are given in linear size: each new article with the number of its
matches, and the members of each matching group, from which the pairs follow. A group holding
a third of all articles costs its rows once, not their square.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echowire.functions.numbers import pair_product, pair_sum
from echowire.operators.figures import content_percentages, one_row, url_percentages
from echowire.operators.skew import attach
from echowire.sources.intake_log import NEW
from echowire.sources.intake_log import roster as roster_of


def members_of(roster: DataFrame, features: DataFrame) -> DataFrame:
    """Roster rows of the articles the metric can score, with their feature columns."""
    return roster.join(features, "articleId")


def load_counts(members: DataFrame, *by: str) -> DataFrame:
    """Per group and load: new articles of that load and approved articles up to it.

    Counting runs map-side first; the running totals then see one row per group and load.
    Without `by` that is one row per load in all.
    """
    sides = members.select(
        *by,
        "articleId",
        F.explode(F.array(
            F.struct(F.col("newLoad").alias("load"), F.lit(True).alias("isNew")),
            F.struct(F.col("approvedLoad").alias("load"), F.lit(False).alias("isNew")),
        )).alias("side"),
    ).where("side.load is not null")
    is_new = F.col("side.isNew")
    counts = sides.groupBy(*by, F.col("side.load").alias("load")).agg(
        F.count_if(is_new).alias("newCount"),
        F.count_if(~is_new).alias("approvedHere"),
        F.min(F.when(is_new, F.col("articleId"))).alias("firstNew"),
        F.min(F.when(~is_new, F.col("articleId"))).alias("firstHere"),
        F.max(F.when(~is_new, F.col("articleId"))).alias("lastHere"),
    )
    if not by:
        counts = counts.withColumn("everything", F.lit(0))
    until_load = (
        Window.partitionBy(*by or ["everything"]).orderBy("load")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return counts.select(
        *by,
        "load",
        "newCount",
        "approvedHere",
        "firstNew",
        F.sum("approvedHere").over(until_load).alias("approvedCount"),
        F.min("firstHere").over(until_load).alias("firstApproved"),
        F.max("lastHere").over(until_load).alias("lastApproved"),
    )


def _pairs() -> Column:
    return pair_product(F.col("newCount"), F.col("approvedCount"))


def pair_count(members: DataFrame, name: str = "total_pairs") -> DataFrame:
    """Number of implied pairs."""
    return load_counts(members).agg(pair_sum(_pairs()).alias(name))


def pair_stats(roster: DataFrame) -> DataFrame:
    """Implied pairs, and the new and the approved articles that occur in any of them."""
    counts = load_counts(roster)
    # an approved article is in some pair if a load from its own onwards lists a new one
    later = Window.partitionBy("everything").orderBy(F.desc("load")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    rows = counts.withColumn("everything", F.lit(0)).withColumn(
        "newFromHere", F.sum("newCount").over(later)
    )
    return rows.agg(
        pair_sum(_pairs()).alias("total_pairs"),
        F.coalesce(F.sum(F.when(F.col("approvedCount") > 0, F.col("newCount"))), F.lit(0)).alias(
            "unique_new_articles"
        ),
        F.coalesce(F.sum(F.when(F.col("newFromHere") > 0, F.col("approvedHere"))), F.lit(0)).alias(
            "unique_approved_articles"
        ),
    )


def load_result(log: DataFrame, added: DataFrame, approved_ids: DataFrame) -> DataFrame:
    """Outcome of a load, given the log before it and the rows it adds.

    new_pairs, existing_pairs (listed x approved, less the new ones), total_pairs, ids loaded
    and approved articles.
    """
    row = one_row(
        pair_count(roster_of(log), "pairs_before"),
        pair_count(roster_of(log.unionByName(added)), "total_pairs"),
        added.agg(F.count_if(F.col("role") == NEW).alias("csv_articles_loaded")),
        approved_ids.agg(F.count_distinct("articleId").alias("approved_articles")),
    )
    new_pairs = F.col("total_pairs") - F.col("pairs_before")
    possible = pair_product(F.col("csv_articles_loaded"), F.col("approved_articles"))
    return row.select(
        new_pairs.alias("new_pairs"),
        (possible - new_pairs).alias("existing_pairs"),
        "total_pairs",
        "csv_articles_loaded",
        "approved_articles",
    )


def _keyed(roster: DataFrame, features: DataFrame) -> DataFrame:
    return members_of(roster, features).where(F.col("key").isNotNull())


def match_groups(roster: DataFrame, features: DataFrame) -> DataFrame:
    """One row per key with at least one matching pair: its members by role and its pairs."""
    counts = load_counts(_keyed(roster, features), "key")
    groups = counts.groupBy("key").agg(
        F.sum("newCount").alias("newArticles"),
        F.sum("approvedHere").alias("approvedArticles"),
        pair_sum(_pairs()).alias("pairs"),
        F.min("firstApproved").alias("firstApproved"),
    )
    return groups.where("pairs > 0")


def match_members(roster: DataFrame, features: DataFrame) -> DataFrame:
    """The members of every matching group; (n, a) of one key match if approvedLoad <= newLoad."""
    groups = match_groups(roster, features).select(
        "key", (F.col("newArticles") + F.col("approvedArticles")).alias("size")
    )
    members = _keyed(roster, features).select("key", "articleId", "newLoad", "approvedLoad")
    return attach(members, groups, ["key"], spread=["articleId"], size="size").drop("size")


def match_report(roster: DataFrame, features: DataFrame, exclude_self: bool = False) -> DataFrame:
    """Each new article that matches: its key, the number of matches and one of them.

    The partner is the matching approved article with the lowest id. With `exclude_self` an
    article that is both new and approved does not match itself; where it would be its own
    partner, the highest id stands in.
    """
    members = _keyed(roster, features)
    groups = load_counts(members, "key").where("newCount > 0 and approvedCount > 0")
    if exclude_self:
        alone = "newCount = 1 and approvedCount = 1 and firstNew = firstApproved"
        groups = groups.where(f"not ({alone})")
    rows = members.where("newLoad is not null").select(
        "articleId",
        "key",
        F.col("newLoad").alias("load"),
        F.coalesce(F.col("approvedLoad") <= F.col("newLoad"), F.lit(False)).alias("isSelf"),
    )
    joined = attach(rows, groups, ["key", "load"], spread=["articleId"], size="newCount")
    partner, matches = F.col("firstApproved"), F.col("approvedCount")
    if exclude_self:
        partner = F.when(partner == F.col("articleId"), F.col("lastApproved")).otherwise(partner)
        matches = matches - F.col("isSelf").cast("bigint")
    return joined.select(
        "articleId", "key", matches.alias("matches"), partner.alias("partnerId")
    ).where("matches > 0")


def exact_progress(
    roster: DataFrame, features: DataFrame, prefix: str, matching: str
) -> DataFrame:
    """Total, completed, pending and matching pairs of one exact metric."""
    row = one_row(
        pair_count(roster),
        pair_count(members_of(roster, features), f"{prefix}_completed"),
        match_groups(roster, features).agg(pair_sum(F.col("pairs")).alias(matching)),
    )
    return row.select(
        "total_pairs",
        f"{prefix}_completed",
        (F.col("total_pairs") - F.col(f"{prefix}_completed")).alias(f"{prefix}_pending"),
        matching,
    )


def url_progress(roster: DataFrame, features: DataFrame) -> DataFrame:
    row = exact_progress(roster, features, "url_check", "matching_urls")
    return row.withColumns(url_percentages())


def content_progress(roster: DataFrame, features: DataFrame) -> DataFrame:
    row = exact_progress(roster, features, "content_hash", "matching_content")
    return row.withColumns(content_percentages())
