"""Bucketed snapshots: the same rows as plain ones, and no shuffle of the snapshot before."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from echowire.operators import features, ratings as R
from echowire.plans import passes
from echowire.sources import snapshots, tables

T0, T1 = (datetime(2024, m, 1, tzinfo=timezone.utc) for m in (1, 2))


def above_scan(df, path):
    """Names of the plan's nodes above the scan of `path`."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    found = []
    for i, line in enumerate(lines):
        if path in line:
            depth, held = len(line) - len(line.lstrip(" :+-")), []
            for above in reversed(lines[:i]):
                own = len(above) - len(above.lstrip(" :+-"))
                if own < depth:
                    depth = own
                    held.append(above.strip(" :+-"))
            found.append(held)
    return found


@pytest.fixture
def long_plans(spark):
    key = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(key)
    spark.conf.set(key, "1000")
    yield
    spark.conf.set(key, before)


def pairs(spark, n, new, approved):
    return spark.range(n).select((F.col("id") % new).alias("articleIdNew"), (F.col("id") % approved).alias("articleIdApproved"))


def test_insert_and_fill_leave_the_old_snapshot_in_place(spark, tmp_path, long_plans):
    v0, v1, v2 = (str(tmp_path / f"v{i}") for i in range(3))
    plain = R.insert_or_ignore(tables.empty_ratings(spark), pairs(spark, 300, 20, 7), T0)
    old = snapshots.write_bucketed(snapshots.bucketed(plain, 5), v0, 5)
    more = pairs(spark, 900, 25, 9).unionByName(spark.createDataFrame([(3, 3)] * 50, "articleIdNew long, articleIdApproved long"))

    scans = above_scan(passes.bucketed_insert(old, more, T1, 5), v0)
    assert len(scans) == 2 and not [n for s in scans for n in s if "Exchange" in n]
    loaded = passes.bucketed_load(old, more, v1, T1, 5)
    expected = R.insert_or_ignore(plain, more, T1)
    assert sorted(map(tuple, loaded.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)

    articles = spark.createDataFrame([(i, f"http://x.com/{i % 4}") for i in range(22)], tables.ARTICLES)
    vectors = spark.createDataFrame([(i, [float(i % 3), 1.0]) for i in range(24)], tables.VECTORS)
    made = {"urlCheck": features.url_features(articles), "embeddingSearch": features.vector_features(vectors)}
    values = passes.stored(R.article_values(made), "values")
    scores = passes.stored(R.pending_scores(loaded, values), "scores")
    scans = above_scan(passes.bucketed_scores(loaded, scores, list(made), T1), v1)
    assert len(scans) == 1 and not [n for n in scans[0] if "Exchange" in n]
    filled = passes.bucketed_fill(loaded, made, v2, T1, 5)
    direct = passes.fill_pass(expected, made, str(tmp_path / "plain"), T1)
    assert filled.columns == direct.columns
    assert sorted(map(tuple, filled.collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)
    assert filled.where("urlCheck IS NOT NULL").count() > 0 < filled.where("urlCheck IS NULL").count()


def test_read_in_another_session_and_existing_path(spark, tmp_path):
    path = str(tmp_path / "v0")
    rows = R.insert_or_ignore(tables.empty_ratings(spark), pairs(spark, 50, 5, 9), T0)
    held = snapshots.write_bucketed(rows, path, 4)
    with pytest.raises(ValueError, match="exists"):
        snapshots.write_bucketed(rows, path, 4)
    spark.sql(f"DROP TABLE {snapshots._table_name(path)}")  # the files stay, as a new session finds them
    again = snapshots.read_bucketed(spark, path, 4)
    assert again.schema == held.schema and sorted(again.collect()) == sorted(rows.collect())
    with pytest.raises(ValueError, match="not exist"):
        snapshots.read_bucketed(spark, str(tmp_path / "none"))


def test_empty_snapshot(spark, tmp_path):
    empty = snapshots.write_bucketed(tables.empty_ratings(spark), str(tmp_path / "v0"), 3)
    assert empty.count() == 0
    loaded = passes.bucketed_load(empty, pairs(spark, 4, 2, 2), str(tmp_path / "v1"), T0, 3)
    assert loaded.count() == 2
