"""Figures of the ratings kept by increments, so that a status report reads no ratings.

A ledger is a folder beside the snapshots. Each step that makes a snapshot enters what it has changed: an insert the pairs
and articles it adds, a fill the scores it gives, an emptied column what it loses. An entry is one row of sums, all of
which add up, so the figures of the newest snapshot are the sums over all entries. Which articles occur in any pair
cannot be summed; the ledger lists them by entry, and an insert counts those not listed before, so it reads
ids, not pairs.

Steps are numbered and each is entered once: entering a number again is an error, so a step that is repeated after a failure
cannot count twice. Entries that a failed step left unfinished (no figures) are replaced when the step is entered again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from echowire.operators.figures import content_percentages, embedding_percentages, one_row, url_percentages
from echowire.operators.ratings import HIGH_SIMILARITY
from echowire.plans.reports import approved_count
from echowire.session import path_exists
from echowire.sources.tables import METRICS, PAIR

_COUNTS = (
    "total_pairs", "unique_new_articles", "unique_approved_articles", "url_check_completed", "matching_urls",
    "content_hash_completed", "matching_content", "embedding_search_completed", "high_similarity_pairs",
)
_OF_METRIC = {
    "urlCheck": ("url_check_completed", "matching_urls"),
    "contentHash": ("content_hash_completed", "matching_content"),
    "embeddingSearch": ("embedding_search_completed", "high_similarity_pairs", "score_sum"),
}
ENTRIES = T.StructType(
    [T.StructField("step", T.IntegerType()), T.StructField("threshold", T.DoubleType())]
    + [T.StructField(name, T.LongType()) for name in _COUNTS] + [T.StructField("score_sum", T.DoubleType())]
)
_IDS = "step int, role string, articleId long"


def _entries(spark: SparkSession, ledger: str) -> DataFrame:
    if not path_exists(spark, f"{ledger}/figures"):
        return spark.createDataFrame([], ENTRIES)
    return spark.read.schema(ENTRIES).parquet(f"{ledger}/figures/*")


def _known_ids(spark: SparkSession, ledger: str, step: int) -> DataFrame:
    """Articles listed by finished steps before `step`."""
    if not path_exists(spark, f"{ledger}/ids"):
        return spark.createDataFrame([], _IDS)
    done = _entries(spark, ledger).select("step")
    listed = spark.read.schema(_IDS).parquet(f"{ledger}/ids/*").where(F.col("step") < step)
    return listed.join(F.broadcast(done), "step", "left_semi")  # one row per step


def _enter(ledger: str, step: int, figures: DataFrame, threshold: float) -> None:
    spark = figures.sparkSession
    if path_exists(spark, f"{ledger}/figures/{step:06d}"):
        raise ValueError(f"step {step} has been entered")
    missing = [f.name for f in ENTRIES.fields if f.name not in figures.columns and f.name not in ("step", "threshold")]
    row = figures.withColumns({
        "step": F.lit(step), "threshold": F.lit(float(threshold)), **{name: F.lit(0) for name in missing}})
    row.select(*(F.coalesce(F.col(f.name), F.lit(0)).cast(f.dataType).alias(f.name) for f in ENTRIES.fields)).coalesce(1).write.parquet(
        f"{ledger}/figures/{step:06d}")


def _scores(of: dict[str, Column], threshold: float) -> list[Column]:
    """Sums over the given score columns."""
    sums = []
    for metric, score in of.items():
        completed, special, *_ = _OF_METRIC[metric]
        sums.append(F.count(score).alias(completed))
        is_special = score > threshold if metric == "embeddingSearch" else score == 1
        sums.append(F.count_if(is_special).alias(special))
        if metric == "embeddingSearch":
            sums.append(F.sum(score).alias("score_sum"))
    return sums


def enter_insert(fresh: DataFrame, ledger: str, step: int, threshold: float = HIGH_SIMILARITY) -> None:
    """Enter rating rows that a step adds (`new_ratings`, written), or a whole first snapshot, scores included."""
    spark = fresh.sparkSession
    sides = [fresh.select(F.lit(role).alias("role"), F.col(role).alias("articleId")) for role in PAIR]
    ids = sides[0].distinct().unionByName(sides[1].distinct())
    added = ids.join(_known_ids(spark, ledger, step).select("role", "articleId"), ["role", "articleId"], "left_anti")
    path = f"{ledger}/ids/{step:06d}"
    added.select(F.lit(step).alias("step"), "role", "articleId").write.mode("overwrite").parquet(path)
    counts = spark.read.schema(_IDS).parquet(path).agg(
        F.count_if(F.col("role") == PAIR[0]).alias("unique_new_articles"),
        F.count_if(F.col("role") == PAIR[1]).alias("unique_approved_articles"),
    )
    sums = fresh.agg(F.count("*").alias("total_pairs"), *_scores({m: F.col(m) for m in METRICS}, threshold))
    _enter(ledger, step, one_row(sums, counts), threshold)


def enter_fill(scores: DataFrame, ledger: str, step: int, threshold: float = HIGH_SIMILARITY) -> None:
    """Enter the scores that a step gives, see `pending_scores`; a stored table."""
    of = {m: F.col(f"new_{m}.score") for m in METRICS if f"new_{m}" in scores.columns}
    _enter(ledger, step, scores.agg(*_scores(of, threshold)), threshold)


def enter_clear(spark: SparkSession, metric: str, ledger: str, step: int, threshold: float = HIGH_SIMILARITY) -> None:
    """Enter that a metric has been emptied; its figures so far are taken back."""
    row = _entries(spark, ledger).agg(*(F.sum(-F.col(name)).alias(name) for name in _OF_METRIC[metric]))
    _enter(ledger, step, row, threshold)


def figures(spark: SparkSession, ledger: str) -> DataFrame:
    """One row: the sums over all entries, which must have been made with one threshold."""
    entries = _entries(spark, ledger)
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in (*_COUNTS, "score_sum")]
    one = F.assert_true(F.coalesce(F.min("threshold") == F.max("threshold"), F.lit(True)), F.lit("entries of different thresholds"))
    return entries.agg(*sums, one.alias("checked")).where("checked IS NULL").drop("checked")


def status_report(spark: SparkSession, ledger: str, approved: DataFrame) -> DataFrame:
    """The row of `reports.status_report`, from the ledger."""
    row = figures(spark, ledger)
    total = F.col("total_pairs")
    done = F.col("embedding_search_completed")
    row = row.withColumns({
        **{f"{p}_pending": total - F.col(f"{p}_completed") for p in ("url_check", "content_hash", "embedding_search")},
        "avg_similarity_score": F.when(done > 0, F.col("score_sum") / done).otherwise(0.0),
    }).drop("score_sum")
    whole = one_row(row, approved_count(approved))
    shares = reduce(lambda a, b: a | b, (url_percentages(), content_percentages(), embedding_percentages()))
    return whole.withColumns({"csv_articles_loaded": F.col("unique_new_articles"), **shares})
