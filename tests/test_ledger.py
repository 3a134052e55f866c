"""Status from a ledger equals the full aggregate after every step."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from echowire.operators import features, ratings as R
from echowire.plans import ledger, passes, reports
from echowire.sources import tables

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def row(df):
    return {k: round(v, 9) if isinstance(v, float) else v for k, v in df.first().asDict().items()}


def pairs(spark, n, new, approved):
    return spark.range(n).select((F.col("id") % new).alias("articleIdNew"), (F.col("id") % approved).alias("articleIdApproved"))


def test_status_after_every_step(spark, tmp_path):
    book = str(tmp_path / "ledger")
    approved = spark.createDataFrame([(i, i, f"h{i % 3}", "t", True) for i in range(15)], tables.APPROVED)
    articles = spark.createDataFrame([(i, f"http://x.com/{i % 4}") for i in range(18)], tables.ARTICLES)
    vectors = spark.createDataFrame([(i, [float(i % 3), 1.0]) for i in range(12)], tables.VECTORS)
    made = {"urlCheck": features.url_features(articles), "contentHash": features.content_features(approved),
            "embeddingSearch": features.vector_features(vectors)}
    values = passes.stored(R.article_values(made), "values")
    held, step = tables.empty_ratings(spark), 0

    def same():
        assert row(ledger.status_report(spark, book, approved)) == row(reports.status_report(held, approved))

    same()
    for new in (pairs(spark, 60, 6, 5), pairs(spark, 200, 20, 7), pairs(spark, 60, 6, 5)):
        fresh = passes.stored(R.new_ratings(held, new, T0), "fresh")
        ledger.enter_insert(fresh, book, step)
        held, step = passes.stored(held.unionByName(fresh), "held"), step + 1
        same()
        scores = passes.stored(R.pending_scores(held, values), "scores")
        ledger.enter_fill(scores, book, step)
        held, step = passes.stored(R.fill_pending(held, values, T0), "held"), step + 1
        same()
    for metric in tables.METRICS:
        ledger.enter_clear(spark, metric, book, step)
        held, step = R.clear_metric(held, metric, T0), step + 1
        same()
    only = values.select("articleId", "contentHash")
    ledger.enter_fill(R.pending_scores(held, only), book, step)
    held = R.fill_pending(held, only, T0)
    same()

    # nothing but the ledger and the approvals is read
    plan = ledger.status_report(spark, book, approved)._jdf.queryExecution().toString()
    assert "articleIdNew" not in plan
    with pytest.raises(ValueError, match="entered"):
        ledger.enter_fill(R.pending_scores(held, values), book, step)


def test_a_first_snapshot_with_scores(spark, tmp_path):
    book = str(tmp_path / "ledger")
    rows = R.insert_or_ignore(tables.empty_ratings(spark), pairs(spark, 30, 5, 6), T0)
    rows = rows.withColumns({"urlCheck": F.lit(1.0), "embeddingSearch": F.col("articleIdNew") / 5})
    ledger.enter_insert(rows, book, 0, threshold=0.5)
    approved = spark.createDataFrame([], tables.APPROVED)
    assert row(ledger.status_report(spark, book, approved)) == row(reports.status_report(rows, approved, 0.5))
    ledger.enter_clear(spark, "urlCheck", book, 1, threshold=0.6)
    with pytest.raises(Exception, match="different thresholds"):
        ledger.figures(spark, book).collect()


def test_an_unfinished_step_is_entered_again(spark, tmp_path):
    book = str(tmp_path / "ledger")
    rows = R.insert_or_ignore(tables.empty_ratings(spark), pairs(spark, 30, 5, 6), T0)
    rows.select(F.lit(0).alias("step"), F.lit("articleIdNew").alias("role"), F.col("articleIdNew").alias("articleId")).write.parquet(
        f"{book}/ids/000000")
    ledger.enter_insert(rows, book, 0)
    ledger.enter_insert(rows.limit(0), book, 1)
    figures = ledger.figures(spark, book).first()
    assert (figures.total_pairs, figures.unique_new_articles, figures.unique_approved_articles) == (30, 5, 6)
