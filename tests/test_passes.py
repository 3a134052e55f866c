from datetime import datetime, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from echowire.operators import features, ratings as R
from echowire.plans import passes, reports
from echowire.sources import tables

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture
def encoder():
    """Toy encoder: counts of two letters."""
    return lambda: lambda texts: np.array([[t.count("a"), t.count("b")] for t in texts], dtype=np.float32)


@pytest.fixture
def approved(spark):
    rows = [(1, 1, "aa", "a", True), (2, 2, "a", "a", True), (9, 2, "b", "b", True), (3, 3, " ", None, True),
            (4, 4, "b", None, True)]
    return spark.createDataFrame(rows, tables.APPROVED)


def test_encoded_vectors(approved, encoder, tmp_path):
    vectors = passes.text_vectors(approved, encoder, 2, str(tmp_path / "vectors"))
    assert {r.articleId: r.embedding for r in vectors.collect()} == {
        1: [3.0, 0.0], 2: [2.0, 0.0], 3: [0.0, 0.0], 4: [0.0, 1.0]}


def test_three_passes_over_stored_snapshots(spark, approved, encoder, tmp_path):
    articles = spark.createDataFrame([(i, f"http://www.x.com/{i % 2}/") for i in range(1, 5)], tables.ARTICLES)
    pairs = spark.createDataFrame(
        [(n, a) for n in (1, 2) for a in (1, 2, 3, 4, 5)], "articleIdNew bigint, articleIdApproved bigint")
    rows = passes.load_pairs(tables.empty_ratings(spark), pairs, str(tmp_path / "v0"), T0)
    scored = passes.url_pass(rows, articles, str(tmp_path / "v1"), T0)
    assert reports.url_run_result(scored).first().asDict() == {
        "processed_pairs": 8, "url_matches_found": 4, "match_rate": 50.0}
    rows = tables.read_ratings(spark, str(tmp_path / "v1"))
    assert rows.columns == [f.name for f in tables.RATINGS.fields]
    passes.content_pass(rows, approved, str(tmp_path / "v2"), T0)
    vectors = passes.text_vectors(approved, encoder, 2, str(tmp_path / "vectors"))
    rows = tables.read_ratings(spark, str(tmp_path / "v2"))
    final = passes.embedding_pass(rows, vectors, str(tmp_path / "v3"), T0)
    cells = {(r.articleIdNew, r.articleIdApproved): (r.urlCheck, r.contentHash, r.embeddingSearch)
             for r in final.collect()}
    assert cells[(1, 1)] == (1.0, 1.0, 1.0)
    assert cells[(1, 2)] == (0.0, 0.0, 1.0)
    assert cells[(1, 3)] == (1.0, 0.0, 0.0)
    assert cells[(2, 4)] == (1.0, 0.0, 0.0)
    assert cells[(2, 5)] == (None, None, None)
    status = reports.status_report(R.rating_rows(final), approved).first()
    assert (status.url_check_completed, status.content_hash_completed, status.embedding_search_completed) == (8, 8, 8)
    assert (status.completion_percentage, status.content_completion_percentage) == (80.0, 80)


def test_one_pass_fills_what_three_would(spark, approved, encoder, tmp_path):
    articles = spark.createDataFrame([(i, f"http://www.x.com/{i % 2}/") for i in range(1, 5)] + [(6, None)], tables.ARTICLES)
    vectors = spark.createDataFrame(
        [(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, None), (4, [1.0]), (6, [0.0, 1.0])], tables.VECTORS)
    pairs = spark.createDataFrame(
        [(n, a) for n in (1, 2, 6) for a in range(1, 8)], "articleIdNew bigint, articleIdApproved bigint")
    rows = R.insert_or_ignore(tables.empty_ratings(spark), pairs, T0)
    some = F.when(F.col("articleIdApproved") == 2, 0.25)
    rows = passes.write_snapshot(rows.withColumns({"contentHash": some, "urlCheck": F.when(F.col("articleIdNew") == 6, 0.5)}), str(tmp_path / "v0"))
    later = datetime(2024, 3, 1, tzinfo=timezone.utc)
    step = passes.url_pass(rows, articles, str(tmp_path / "v1"), later)
    step = passes.content_pass(R.rating_rows(step), approved, str(tmp_path / "v2"), later)
    step = passes.embedding_pass(R.rating_rows(step), vectors, str(tmp_path / "v3"), later)
    made = {"urlCheck": features.url_features(articles), "contentHash": features.content_features(approved),
            "embeddingSearch": features.vector_features(vectors)}
    whole = passes.fill_pass(rows, made, str(tmp_path / "v4"), later)
    assert whole.columns == R.rating_rows(step).columns
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, R.rating_rows(step).collect()), key=repr)


def test_features_are_extended_not_recomputed(spark):
    def rows(*items):
        return spark.createDataFrame(list(items), tables.ARTICLES)

    first = features.url_features(rows((1, "a.com"), (2, None)))
    second = passes.extend_features(first, rows((1, "changed.com"), (3, "b.com")), "id", features.url_features)
    keys = {r.articleId: r.key for r in second.collect()}
    assert set(keys) == {1, 2, 3} and keys[1] != keys[3] and keys[2] is None
    assert keys[1] == {r.articleId: r.key for r in first.collect()}[1]


def test_only_approved_option(spark, tmp_path):
    path = str(tmp_path / "approved")
    spark.createDataFrame([(1, 1, None, "a", True), (2, 2, None, "b", False)], tables.APPROVED).write.parquet(path)
    assert tables.read_approved(spark, path).count() == 2
    assert [r.articleId for r in tables.read_approved(spark, path, only_approved=True).collect()] == [1]
