"""How far the states of two articles overlap, from bitmaps.

A relation names the states of each article. Its states are bits in words of 64, so an article is one small row however often
a state is listed, and the overlap of a pair is a population count of words both have: common states over all states of
either (Jaccard). Counting runs map-side, and bitmaps are attached to pairs so that an article that occurs in a large part
of all pairs is served by broadcast.

A row is as wide as the number of words with any of the article's states, so at most the number of states over 64.

Cases: rows without an article or a state are left out, repeated ones count once. A pair with an article that has no
states stays without a score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echowire.operators.skew import attach

_WORDS = "map<bigint,bigint>"


def state_bitmaps(relation: DataFrame) -> DataFrame:
    """articleId, states (how many) and words (bits by word number), from rows of articleId and stateId."""
    bits = relation.where("articleId IS NOT NULL AND stateId IS NOT NULL").select(
        "articleId", F.col("stateId").cast("bigint").alias("state"))
    words = bits.groupBy("articleId", F.shiftright("state", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(state & 63 AS int))")).alias("bits"))
    return words.groupBy("articleId").agg(
        F.sum(F.bit_count("bits")).alias("states"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("word", "bits")))).cast(_WORDS).alias("words"),
    )


def common_states(left: Column, right: Column) -> Column:
    """How many bits two maps of words have in common."""
    def of_word(sum_: Column, entry: Column) -> Column:
        other = F.coalesce(F.try_element_at(right, entry["key"]), F.lit(0).cast("bigint"))
        return sum_ + F.bit_count(entry["value"].bitwiseAND(other))

    return F.aggregate(F.map_entries(left), F.lit(0).cast("bigint"), of_word)


def state_overlap(pairs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """articleIdNew, articleIdApproved, the states of each and in common, and signatureMatchState: common over all.

    `bitmaps` has one row per article; write it first, as several joins read it. Pairs without states have nulls.
    """
    ends = ("articleIdNew", "articleIdApproved")
    rows = pairs.select(*ends)
    for end, other, name in zip(ends, reversed(ends), ("new", "approved")):
        own = bitmaps.select(
            F.col("articleId").alias(end), F.col("states").alias(f"{name}States"), F.col("words").alias(f"{name}Words"))
        rows = attach(rows, own, [end], [other], how="left")
    known = F.col("newStates").isNotNull() & F.col("approvedStates").isNotNull()
    rows = rows.withColumn("commonStates", F.when(known, common_states(F.col("newWords"), F.col("approvedWords"))))
    either = F.col("newStates") + F.col("approvedStates") - F.col("commonStates")
    return rows.select(
        *ends, "newStates", "approvedStates", "commonStates", (F.col("commonStates") / either).alias("signatureMatchState"))


def state_progress(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Total, completed and pending pairs, those with equal states, those above the threshold, and the mean score."""
    score = F.col("signatureMatchState")
    return scored.agg(
        F.count("*").alias("total_pairs"), F.count(score).alias("state_completed"),
        (F.count("*") - F.count(score)).alias("state_pending"), F.count_if(score == 1).alias("equal_states"),
        F.count_if(score > threshold).alias("high_overlap"), F.coalesce(F.avg(score), F.lit(0.0)).alias("avg_overlap"),
    )
