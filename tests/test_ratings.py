from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from echowire.operators import features, ratings as R
from echowire.plans import reports
from echowire.sources import tables

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
T1 = datetime(2024, 1, 2, tzinfo=timezone.utc)
STAMP0, STAMP1 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


@pytest.fixture(scope="module")
def data(spark):
    articles = spark.createDataFrame(
        [(1, "http://www.a.com/x/"), (2, "https://a.com/x?utm_source=f"), (3, None), (4, "https://b.com"),
         (5, "https://a.com/x")], tables.ARTICLES)
    approved = spark.createDataFrame(
        [(12, 2, "Other", "words", True), (11, 2, "Hello", "World", False), (13, 4, "hello!", "world", True),
         (14, 1, "HELLO", "  world.", True), (15, 3, None, "世界", True), (16, 6, "", "мир", True)],
        tables.APPROVED)
    vectors = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, [-1.0, 0.0]), (6, [1.0]), (5, None)],
        tables.VECTORS)
    pairs = spark.createDataFrame(
        [(n, a) for n in (1, 3, 5) for a in (2, 3, 4, 6)] + [(1, 2)], "articleIdNew bigint, articleIdApproved bigint")
    return articles, approved, vectors, pairs


def _cells(ratings, metric):
    return {(r.articleIdNew, r.articleIdApproved): r[metric] for r in ratings.collect()}


def _stamps(ratings, column="updatedAt"):
    rows = ratings.select(*tables.PAIR, F.col(column).cast("string").alias("t")).collect()
    return {(r.articleIdNew, r.articleIdApproved): r.t for r in rows}


@pytest.fixture(scope="module")
def loaded(spark, data):
    return R.insert_or_ignore(tables.empty_ratings(spark), data[3], T0).cache()


def test_insert_or_ignore(spark, data, loaded):
    assert loaded.count() == 12
    assert set(_stamps(loaded, "createdAt").values()) == {STAMP0}
    again = R.insert_or_ignore(loaded, data[3].unionByName(
        spark.createDataFrame([(9, 2), (9, 2)], data[3].schema)), T1)
    assert again.count() == 13
    assert R.new_ratings(loaded, data[3], T1).count() == 0
    assert _stamps(again)[(1, 2)] == STAMP0 and _stamps(again)[(9, 2)] == STAMP1
    ids = spark.createDataFrame([(1,), (3,), (77,)], "articleId bigint")
    assert R.existing_pair_count(loaded, ids).first().existing_pairs == 8
    assert R.existing_pairs(loaded, ids).count() == 8


def test_url_pass(data, loaded):
    scored = R.score_pending(loaded, "urlCheck", features.url_features(data[0]), T1)
    cells = _cells(scored, "urlCheck")
    assert cells == {
        (1, 2): 1.0, (1, 3): 0.0, (1, 4): 0.0, (1, 6): None,
        (3, 2): 0.0, (3, 3): 0.0, (3, 4): 0.0, (3, 6): None,
        (5, 2): 1.0, (5, 3): 0.0, (5, 4): 0.0, (5, 6): None,
    }
    stamps = _stamps(scored)
    assert stamps[(1, 2)] == STAMP1 and stamps[(1, 6)] == STAMP0
    assert reports.url_run_result(scored).first().asDict() == {
        "processed_pairs": 9, "url_matches_found": 2, "match_rate": 22.22}
    assert reports.url_status(scored).first().asDict() == {
        "total_pairs": 12, "url_check_completed": 9, "url_check_pending": 3, "matching_urls": 2,
        "completion_percentage": 75.0, "match_percentage": 22.2}


def test_content_pass_uses_lowest_approval(data, loaded):
    scored = R.score_pending(loaded, "contentHash", features.content_features(data[1]), T1)
    assert _cells(scored, "contentHash") == {
        (1, 2): 1.0, (1, 3): 0.0, (1, 4): 1.0, (1, 6): 0.0,
        (3, 2): 0.0, (3, 3): 1.0, (3, 4): 0.0, (3, 6): 1.0,
        (5, 2): None, (5, 3): None, (5, 4): None, (5, 6): None,
    }
    assert reports.content_run_result(scored).first().asDict() == {
        "processed": 8, "matches": 4, "non_matches": 4, "errors": 0, "match_rate": 50}
    strict = R.score_pending(loaded, "contentHash", features.content_features(data[1], min_chars=1), T1)
    assert {k for k, v in _cells(strict, "contentHash").items() if v == 1.0} == {(1, 2), (1, 4)}


def test_embedding_pass(data, loaded):
    scored = R.score_pending(loaded, "embeddingSearch", features.vector_features(data[2]), T1)
    cells = _cells(scored, "embeddingSearch")
    assert cells == {
        (1, 2): 1.0, (1, 3): 0.0, (1, 4): 0.0, (1, 6): 0.0,
        (3, 2): 0.0, (3, 3): 0.0, (3, 4): 0.0, (3, 6): 0.0,
        (5, 2): 0.0, (5, 3): 0.0, (5, 4): 0.0, (5, 6): 0.0,
    }
    row = reports.embedding_run_result(scored).first()
    assert (row.total_processed, row.total_high_similarity, row.total_errors) == (12, 1, 6)
    assert row.overall_avg_similarity == pytest.approx(1 / 6)
    stats = reports.embedding_stats(scored).first()
    assert stats.avg_similarity_score == pytest.approx(1 / 12)
    assert R.high_similarity(scored).count() == 1


@pytest.mark.parametrize("metric", tables.METRICS)
def test_fill_is_idempotent_and_recompute_equals_first(data, loaded, metric):
    made = {
        "urlCheck": lambda: features.url_features(data[0]),
        "contentHash": lambda: features.content_features(data[1]),
        "embeddingSearch": lambda: features.vector_features(data[2]),
    }[metric]()
    once = R.rating_rows(R.score_pending(loaded, metric, made, T1)).cache()
    twice = R.score_pending(once, metric, made, datetime(2025, 1, 1, tzinfo=timezone.utc))
    assert not twice.where("scoredNow").count()
    assert sorted(map(str, R.rating_rows(twice).collect())) == sorted(map(str, once.collect()))
    redone = R.score_pending(once, metric, made, T1, recompute=True)
    assert _cells(redone, metric) == _cells(once, metric)

    some = R.score_pending(loaded, metric, made, T1, limit=2)
    picked = sorted(k for k, v in _cells(some, metric).items() if v is not None)
    assert picked == sorted(k for k, v in _cells(once, metric).items() if v is not None)[:2]


def test_clear_and_reset(data, loaded):
    scored = R.rating_rows(R.score_pending(loaded, "urlCheck", features.url_features(data[0]), T0))
    both = R.rating_rows(R.score_pending(scored, "contentHash", features.content_features(data[1]), T0)).cache()
    no_url = R.clear_metric(both, "urlCheck", T1)
    assert set(_cells(no_url, "urlCheck").values()) == {None}
    assert _cells(no_url, "contentHash") == _cells(both, "contentHash")
    assert set(_stamps(no_url).values()) == {STAMP1}
    no_content = R.clear_metric(both, "contentHash", T1)
    assert set(_cells(no_content, "contentHash").values()) == {None}
    assert set(_stamps(no_content).values()) == {STAMP0}
    assert R.cleared_count(both, "urlCheck").first().cleared == 12
    assert R.cleared_count(both, "contentHash").first().cleared == 8
    with pytest.raises(ValueError):
        R.reset(both)
    assert R.reset(both, confirm=True).count() == 0
    assert R.reset(both, confirm=True).schema == both.schema


def test_pending_views(data, loaded):
    rows = R.pending_with(loaded, "urlCheck", data[0], "id", "url")
    assert rows.columns == [*tables.PAIR, "urlNew", "urlApproved"] or set(rows.columns) == {
        *tables.PAIR, "urlNew", "urlApproved"}
    assert rows.count() == 9
    first = R.pending_with(loaded, "urlCheck", data[0], "id", "url", limit=1).first()
    assert (first.articleIdNew, first.articleIdApproved) == (1, 2)
    texts = R.pending_with(
        loaded, "contentHash", features.first_approvals(data[1]), "articleId", "headline", "text")
    assert texts.count() == 8 and {"headlineNew", "textApproved"} <= set(texts.columns)


def test_sample(data, loaded):
    scored = R.score_pending(loaded, "urlCheck", features.url_features(data[0]), T1)
    rows = reports.best_scored_urls(scored, data[0], 3).collect()
    assert [(r.articleIdNew, r.articleIdApproved, r.urlCheck) for r in rows] == [
        (1, 2, 1.0), (5, 2, 1.0), (1, 3, 0.0)]
    assert rows[0].urlNew == "http://www.a.com/x/" and rows[0].canonicalNew == "https://a.com/x"
    assert rows[2].urlApproved is None and rows[2].canonicalApproved is None


def test_status_report(spark, data, loaded):
    row = reports.status_report(loaded, data[1]).first()
    assert (row.total_pairs, row.unique_new_articles, row.unique_approved_articles) == (12, 3, 4)
    assert (row.approved_articles, row.csv_articles_loaded) == (5, 3)
    empty = reports.status_report(tables.empty_ratings(spark), data[1].limit(0)).first().asDict()
    assert set(empty.values()) == {0, 0.0}


def test_snapshots_are_never_overwritten(loaded, tmp_path):
    path = str(tmp_path / "v1")
    stored = tables.write_snapshot(loaded, path)
    assert stored.count() == 12
    assert tables.read_ratings(stored.sparkSession, path).schema == tables.empty_ratings(stored.sparkSession).schema \
        or tables.read_ratings(stored.sparkSession, path).columns == loaded.columns
    with pytest.raises(Exception, match="exists"):
        tables.write_snapshot(loaded, path)
