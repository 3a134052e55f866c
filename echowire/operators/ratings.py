"""Rating rows: one per pair of article ids, with one nullable score per metric.

Every function takes and returns DataFrames; a changed table is a new DataFrame to be written
as the next snapshot. The cost of each is linear in the rating rows given.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echowire.functions.numbers import timestamp_literal
from echowire.functions.texts import content_score
from echowire.functions.urls import url_score
from echowire.functions.vectors import cosine_score
from echowire.operators.skew import attach
from echowire.sources.tables import METRICS, PAIR, RATINGS

# Fixed value: a pair scoring above it counts as highly similar.
HIGH_SIMILARITY = 0.8


def insert_or_ignore(ratings: DataFrame, pairs: DataFrame, run_ts: datetime) -> DataFrame:
    """`ratings` plus the pairs it does not hold yet, each once, unscored."""
    return ratings.unionByName(new_ratings(ratings, pairs, run_ts))


def new_ratings(ratings: DataFrame, pairs: DataFrame, run_ts: datetime) -> DataFrame:
    """The rows an insert would add."""
    fresh = pairs.select(*PAIR).distinct().join(ratings.select(*PAIR), list(PAIR), "left_anti")
    stamp = timestamp_literal(run_ts)
    return fresh.select(
        *PAIR,
        *(F.lit(None).cast("double").alias(metric) for metric in METRICS),
        stamp.alias("createdAt"),
        stamp.alias("updatedAt"),
    )


def existing_pairs(ratings: DataFrame, new_ids: DataFrame) -> DataFrame:
    """Rating rows whose new article is in the given list."""
    wanted = new_ids.select(F.col("articleId").alias("articleIdNew"))
    return ratings.join(wanted, "articleIdNew", "left_semi")


def existing_pair_count(ratings: DataFrame, new_ids: DataFrame) -> DataFrame:
    """Number of rating rows of the given new articles, counted per article before the join."""
    per_article = ratings.groupBy("articleIdNew").agg(F.count("*").alias("pairs"))
    kept = existing_pairs(per_article, new_ids)
    return kept.agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("existing_pairs"))


def pending(ratings: DataFrame, metric: str) -> DataFrame:
    return ratings.where(F.col(metric).isNull())


def completed(ratings: DataFrame, metric: str) -> DataFrame:
    return ratings.where(F.col(metric).isNotNull())


def exact_matches(ratings: DataFrame, metric: str) -> DataFrame:
    return ratings.where(F.col(metric) == 1)


def high_similarity(ratings: DataFrame, threshold: float = HIGH_SIMILARITY) -> DataFrame:
    return ratings.where(F.col("embeddingSearch") > threshold)


def with_article_columns(ratings: DataFrame, table: DataFrame, key: str, *columns: str) -> DataFrame:
    """Inner join with an article table on both ids; columns come back as `<name>New` and
    `<name>Approved`. The table has one row per id and columns of moderate width: those of the most
    frequent ids are broadcast, see `attach`."""
    for role in ("New", "Approved"):
        side = table.select(
            F.col(key).alias(f"articleId{role}"), *(F.col(c).alias(f"{c}{role}") for c in columns)
        )
        ratings = attach(ratings, side, [f"articleId{role}"], spread=PAIR)
    return ratings


def with_both(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    """Pairs of which both ids are in `ids` (articleId); only ids are joined."""
    marked = ids.select(F.col("articleId")).distinct()
    for role in PAIR:
        side = marked.select(F.col("articleId").alias(role), F.lit(True).alias("__held"))
        pairs = attach(pairs, side, [role], spread=PAIR).drop("__held")
    return pairs


def pending_with(
    ratings: DataFrame, metric: str, table: DataFrame, key: str, *columns: str, limit: int | None = None
) -> DataFrame:
    """Pending pairs that can be scored, with the article columns to score; at most `limit`.

    With a limit the pairs are chosen on ids alone and the columns joined to those that remain.
    """
    rows = pending(ratings, metric).select(*PAIR)
    if limit is not None:
        rows = with_both(rows, table.select(F.col(key).alias("articleId"))).orderBy(*PAIR).limit(limit)
    return with_article_columns(rows, table, key, *columns)


def _score(metric: str, of: Callable[[str, str], Column]) -> Column:
    """Score of a pair; `of(name, role)` is a value of the new or the approved article."""
    if metric == "embeddingSearch":
        return cosine_score(of("embedding", "New"), of("embedding", "Approved"))
    rule = url_score if metric == "urlCheck" else content_score
    return rule(of("key", "New"), of("key", "Approved"))


def score_pending(
    ratings: DataFrame,
    metric: str,
    features: DataFrame,
    run_ts: datetime,
    recompute: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """`ratings` with the empty cells of one metric filled, plus `scoredNow` and `failedNow`.

    Rows that have the score already pass through without a join. A pair is scored when both
    articles have a feature row; the others stay empty. A pair whose score cannot be computed
    gets 0.0 and `failedNow`. `recompute` empties the column first. `limit` scores at most
    that many pairs, those with the lowest ids.
    """
    if recompute:
        ratings = clear_metric(ratings, metric, run_ts)
    unscored = pending(ratings, metric)
    if limit is not None:
        ids = features.select("articleId")
        chosen = with_both(unscored.select(*PAIR), ids).orderBy(*PAIR).limit(limit)
        left = unscored.join(chosen, list(PAIR), "left_anti")
        unscored = unscored.join(chosen, list(PAIR), "left_semi")
    todo = unscored
    for role in ("New", "Approved"):
        side = features.select(
            F.col("articleId").alias(f"articleId{role}"),
            *(F.col(c).alias(f"{c}{role}") for c in features.columns if c != "articleId"),
            F.lit(True).alias(f"has{role}"),
        )
        todo = attach(
            todo, side, [f"articleId{role}"], spread=PAIR, how="left", counted=unscored
        )

    scorable = F.col("hasNew").isNotNull() & F.col("hasApproved").isNotNull()
    rows = [f.name for f in RATINGS.fields]
    scored = todo.withColumn("rawScore", _score(metric, lambda name, role: F.col(f"{name}{role}"))).withColumns({
        "scoredNow": scorable,
        "failedNow": scorable & F.col("rawScore").isNull(),
        metric: F.when(scorable, F.coalesce("rawScore", F.lit(0.0))),
        "updatedAt": F.when(scorable, timestamp_literal(run_ts)).otherwise(F.col("updatedAt")),
    })
    untouched = completed(ratings, metric)
    if limit is not None:
        untouched = untouched.unionByName(left)
    untouched = untouched.withColumns({"scoredNow": F.lit(False), "failedNow": F.lit(False)})
    columns = rows + ["scoredNow", "failedNow"]
    return untouched.select(*columns).unionByName(scored.select(*columns))


def article_values(features: dict[str, DataFrame]) -> DataFrame:
    """articleId and, per metric, what it compares of the article; null where the metric has no row for it."""
    parts = [
        made.select("articleId", F.struct(*(c for c in made.columns if c != "articleId")).alias(metric))
        for metric, made in features.items()
    ]
    return reduce(lambda left, right: left.join(right, "articleId", "full"), parts)


def pending_scores(ratings: DataFrame, values: DataFrame, *keep: str) -> DataFrame:
    """Pairs with an empty cell, the columns `keep`, and per metric of `values` (see `article_values`, a stored table) a
    struct of score and failure, null where the cell is full or the pair cannot be scored.

    All metrics are scored together, so a pair is joined with its two articles once, not once per metric.
    """
    metrics = [c for c in values.columns if c != "articleId"]
    empty = reduce(Column.__or__, (F.col(m).isNull() for m in metrics))
    unscored = ratings.where(empty)
    todo = unscored.select(*PAIR, *keep, *(F.col(m).isNull().alias(f"__{m}") for m in metrics))
    for role in ("New", "Approved"):
        side = values.select(F.col("articleId").alias(f"articleId{role}"), *(F.col(m).alias(f"{m}{role}") for m in metrics))
        todo = attach(todo, side, [f"articleId{role}"], spread=PAIR, how="left", counted=unscored)
    for m in metrics:
        due = F.col(f"__{m}") & F.col(f"{m}New").isNotNull() & F.col(f"{m}Approved").isNotNull()
        raw = _score(m, lambda name, role, m=m: F.col(f"{m}{role}.{name}"))
        todo = todo.withColumn(f"__{m}", due).withColumn(f"raw{m}", raw)
    return todo.select(*PAIR, *keep, *(F.when(F.col(f"__{m}"), F.struct(
        F.coalesce(f"raw{m}", F.lit(0.0)).alias("score"), F.col(f"raw{m}").isNull().alias("failed"))).alias(f"new_{m}") for m in metrics))


def with_scores(rows: DataFrame, metrics: Sequence[str], run_ts: datetime) -> DataFrame:
    """Rating rows whose empty cells take the scores in their columns `new_<metric>`."""
    touched = reduce(Column.__or__, (F.col(f"new_{m}").isNotNull() for m in metrics))
    filled = rows.withColumns({
        **{m: F.coalesce(F.col(m), F.col(f"new_{m}.score")) for m in metrics},
        "updatedAt": F.when(touched, timestamp_literal(run_ts)).otherwise(F.col("updatedAt")),
    })
    return rating_rows(filled)


def fill_pending(ratings: DataFrame, values: DataFrame, run_ts: datetime) -> DataFrame:
    """`ratings` with the empty cells of all metrics of `values` filled at once; what passes one by one would give."""
    metrics = [c for c in values.columns if c != "articleId"]
    rest = [c.name for c in RATINGS.fields if c.name not in PAIR]
    full = reduce(Column.__and__, (F.col(m).isNotNull() for m in metrics))
    return ratings.where(full).select(*PAIR, *rest).unionByName(
        with_scores(pending_scores(ratings, values, *rest), metrics, run_ts))


def rating_rows(scored: DataFrame) -> DataFrame:
    """The plain rating columns of a scored snapshot."""
    return scored.select(*(f.name for f in RATINGS.fields))


def clear_metric(ratings: DataFrame, metric: str, run_ts: datetime) -> DataFrame:
    """`ratings` with one metric emptied. Only for URL scores does that count as an update."""
    cleared = ratings.withColumn(metric, F.lit(None).cast("double"))
    if metric == "urlCheck":
        cleared = cleared.withColumn("updatedAt", timestamp_literal(run_ts))
    return cleared


def composite_scores(ratings: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Pairs with `score`, the mean of the metrics they have, and `scoreWeighted`, their weighted mean.

    Metrics without a score are left out of both; a pair without any has NULL. Weights are not negative; by default
    all are 1. A pair whose metrics present have no weight has NULL as its weighted mean.
    """
    weights = {metric: 1.0 for metric in METRICS} | (weights or {})
    if any(w < 0 for w in weights.values()) or set(weights) != set(METRICS):
        raise ValueError(f"weights must be for {METRICS} and not negative")

    def mean(of: dict[str, float]) -> Column:
        present = [F.when(F.col(m).isNotNull(), F.lit(float(w))).otherwise(F.lit(0.0)) for m, w in of.items()]
        parts = [F.coalesce(F.col(m), F.lit(0.0)) * F.lit(float(w)) for m, w in of.items()]
        total = sum(present[1:], present[0])
        return F.when(total > 0, sum(parts[1:], parts[0]) / total)

    return ratings.select(
        *PAIR, mean({m: 1.0 for m in METRICS}).alias("score"), mean(weights).alias("scoreWeighted")
    )


def cleared_count(ratings: DataFrame, metric: str) -> DataFrame:
    """How many rows an emptying touches: all for URL scores, else those with a score."""
    touched = F.count("*") if metric == "urlCheck" else F.count(metric)
    return ratings.agg(touched.alias("cleared"))


def reset(ratings: DataFrame, confirm: bool = False) -> DataFrame:
    """No rows, same schema. The rows lost are those of `ratings.count()`."""
    if not confirm:
        raise ValueError("reset deletes every rating; call it with confirm=True")
    return ratings.limit(0)
