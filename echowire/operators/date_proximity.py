"""How near two articles are in time: 1 on the same day, falling by 1/window with each day, 0 from `window` days on.

Articles of one day and load are one class, counted map-side, so a day with a third of all articles is one row when days
meet. Days are put into buckets of two windows. An approved day goes to its own bucket; the days near a new day lie
in its own bucket and at most one neighbour, so it goes to these two and meets each near day exactly once: a join on the
bucket, in place of one of all days with all.

Cases: articles without a date have no proximity. A date with a time of day counts as its day. Several dates of one
article count as the earliest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echowire.functions.numbers import pair_product, pair_sum
from echowire.operators.implied import members_of
from echowire.operators.skew import attach

WINDOW_DAYS = 7


def day_features(dates: DataFrame) -> DataFrame:
    """articleId and day (a number) from rows of articleId and date."""
    day = F.unix_date(F.to_date("date")).cast("bigint")
    named = dates.where("articleId IS NOT NULL AND date IS NOT NULL").select("articleId", day.alias("day"))
    return named.groupBy("articleId").agg(F.min("day").alias("day"))


def proximity(day_1: Column, day_2: Column, window: int) -> Column:
    return F.greatest(F.lit(0.0), 1 - F.abs(day_1 - day_2) / F.lit(float(window)))


def _checked(window: int) -> int:
    if window < 1:
        raise ValueError("the window must be at least one day")
    return window


def date_scores(pairs: DataFrame, days: DataFrame, window: int = WINDOW_DAYS) -> DataFrame:
    """articleIdNew, articleIdApproved and signatureMatchDate of given pairs; null where a date is missing."""
    ends = ("articleIdNew", "articleIdApproved")
    rows = pairs.select(*ends)
    for end, other, name in zip(ends, reversed(ends), ("newDay", "approvedDay")):
        own = days.select(F.col("articleId").alias(end), F.col("day").alias(name))
        rows = attach(rows, own, [end], [other], how="left")
    score = proximity(F.col("newDay"), F.col("approvedDay"), _checked(window))
    known = F.col("newDay").isNotNull() & F.col("approvedDay").isNotNull()
    return rows.select(*ends, F.when(known, score).alias("signatureMatchDate"))


def day_matches(roster: DataFrame, days: DataFrame, window: int = WINDOW_DAYS) -> DataFrame:
    """Implied pairs fewer than `window` days apart, by days: newDay, newLoad, approvedDay, approvedLoad, days (apart),
    proximity, the articles of both, and pairs. Which articles a day stands for follows from their days."""
    members, wide = members_of(roster, days), 2 * _checked(window)

    def classes(role: str) -> DataFrame:
        load = f"{role}Load"
        return members.where(F.col(load).isNotNull()).groupBy(
            F.col("day").alias(f"{role}Day"), F.col(load)
        ).agg(F.count("*").alias(f"{role}Articles"), F.min("articleId").alias(f"{role}First"))

    def bucket(day: Column) -> Column:
        return F.floor(day / wide)

    near = F.array_distinct(F.array(bucket(F.col("newDay") - (window - 1)), bucket(F.col("newDay") + (window - 1))))
    new = classes("new").withColumn("bucket", F.explode(near))
    met = new.join(classes("approved").withColumn("bucket", bucket(F.col("approvedDay"))), "bucket")
    apart = F.abs(F.col("newDay") - F.col("approvedDay"))
    met = met.where((apart < window) & (F.col("approvedLoad") <= F.col("newLoad")))
    return met.select(
        "newDay", "newLoad", "approvedDay", "approvedLoad", apart.alias("days"),
        proximity(F.col("newDay"), F.col("approvedDay"), window).alias("proximity"), "newArticles", "approvedArticles", "approvedFirst",
        pair_product(F.col("newArticles"), F.col("approvedArticles")).alias("pairs"),
    )


def date_report(roster: DataFrame, days: DataFrame, window: int = WINDOW_DAYS) -> DataFrame:
    """Each new article with a near approved one: how many there are, the nearest one's distance in days, and which it is
    (the lowest id among the nearest)."""
    met = day_matches(roster, days, window)
    figures = met.groupBy(F.col("newDay").alias("day"), "newLoad").agg(
        F.sum("approvedArticles").alias("nearDates"), F.max("newArticles").alias("n"),
        F.min(F.struct("days", "approvedFirst")).alias("nearest"),
    )
    new = members_of(roster, days).where("newLoad IS NOT NULL").select("articleId", "newLoad", "day")
    return attach(new, figures, ["day", "newLoad"], ["articleId"], size="n").select(
        "articleId", "nearDates", F.col("nearest.days").alias("days"), F.col("nearest.approvedFirst").alias("nearestId"))


def date_progress(matches: DataFrame) -> DataFrame:
    """Near pairs, those on one day, and the sum of proximities, from `day_matches`."""
    pairs = F.col("pairs")
    return matches.agg(
        pair_sum(pairs).alias("near_pairs"), pair_sum(F.when(F.col("days") == 0, pairs)).alias("same_day_pairs"),
        F.coalesce(F.sum(F.col("proximity") * pairs.cast("double")), F.lit(0.0)).alias("proximity_sum"),
    )
