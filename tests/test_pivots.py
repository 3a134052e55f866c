import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from echowire.operators import similarity
from echowire.operators.pivot_search import choose_pivots, high_report, pivot_pairs, pivot_shares
from echowire.operators.similarity import class_members, similar_pairs, similarity_report, vector_classes

KEYS = ("newClass", "newLoad", "approvedClass", "approvedLoad")


def groups(seed, groups=12, each=30, dimension=16, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dimension))
    return (centres[rng.integers(groups, size=groups * each)] + spread * rng.normal(size=(groups * each, dimension))).tolist()


def frames(spark, vectors, every=3):
    rows = [(i, v) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "articleId long, embedding array<float>").repartition(4)
    ids = df.select("articleId")
    roster = ids.select(
        "articleId", F.when(F.col("articleId") % every > 0, (F.col("articleId") % 2 + 1).cast("int")).alias("newLoad"),
        F.when(F.col("articleId") % every != 1, F.lit(1)).alias("approvedLoad"))
    return roster, df


def rows(df):
    return {tuple(r[k] for k in KEYS): (round(r.similarity, 9), int(r.pairs)) for r in df.collect()}


ODD = [None, [0.0] * 16, [1.0] * 16, [1.0] * 16, [2.0] * 16, [1.0, 2.0], [2.0, 4.0], [1.0], [float("nan")] * 16, [None] + [1.0] * 15, [float("inf")] * 16, []]


@pytest.mark.parametrize("threshold, pivots, block_rows", [(0.8, 64, None), (0.98, 5, 7), (0.0, 1, 50)])
def test_pairs_equal_the_full_search(spark, threshold, pivots, block_rows):
    roster, vectors = frames(spark, groups(int(threshold * 100)) + ODD + groups(1, each=2, dimension=5))
    expected = rows(similar_pairs(roster, vectors, threshold))
    assert expected and rows(pivot_pairs(roster, vectors, threshold, pivots, block_rows)) == expected


def test_high_counts_equal_the_report(spark):
    roster, vectors = frames(spark, groups(8, groups=5) + ODD)
    got = {r.articleId: (r.high, round(r.best, 9), r.bestId) for r in high_report(roster, vectors, 0.9, 8).collect()}
    full = similarity_report(roster, vectors, 0.9).where("high > 0").collect()
    assert got == {r.articleId: (r.high, round(r.best, 9), r.bestId) for r in full} and len(got) > 50


def test_members_of_a_shared_vector(spark, monkeypatch):
    monkeypatch.setattr("echowire.operators.skew.HOT_KEYS", 1)
    roster, vectors = frames(spark, [[1.0, 0.0]] * 40 + [[0.0, 1.0]] * 5 + [None])
    rows_ = class_members(roster, vectors).collect()
    assert {(r.role, r.load, r.articleId): r.classId for r in rows_} == {
        (role, load, i): min(j for j in range(45) if (j < 40) == (i < 40) and loads(j)[role] == load)
        for i in range(45) for role, load in loads(i).items() if load}


def loads(i):
    return {"new": i % 2 + 1 if i % 3 else None, "approved": 1 if i % 3 != 1 else None}


def test_a_dimension_without_pivots(spark, monkeypatch):
    monkeypatch.setattr("echowire.operators.pivot_search.SAMPLE", 3)
    roster, vectors = frames(spark, groups(3) + groups(4, dimension=7, each=5))
    assert rows(pivot_pairs(roster, vectors, 0.9)) == rows(similar_pairs(roster, vectors, 0.9))


def test_most_pairs_of_grouped_vectors_are_left_out(spark):
    roster, vectors = frames(spark, groups(5, groups=20, each=20))
    row = pivot_shares(roster, vectors, 0.9).first()
    assert row.share_left_out > 0.7 and row.compared < row.class_pairs


def test_pivots_differ(spark):
    roster, vectors = frames(spark, groups(6) + groups(6))
    members = roster.join(vectors, "articleId")
    chosen = choose_pivots(vector_classes(members)[1], 10)[16]
    assert len(chosen) == 10 and (chosen @ chosen.T - 2 * np.eye(10)).max() < 0.9999


def test_empty_and_negative(spark):
    roster, vectors = frames(spark, [])
    assert pivot_pairs(roster, vectors).count() == 0 and pivot_shares(roster, vectors).first().share_left_out == 0.0
    with pytest.raises(ValueError):
        pivot_pairs(roster, vectors, -0.1)


def block(n, own):
    rng = np.random.default_rng(5)
    return pa.table({
        "id": pa.array(range(n)), "load": pa.array([1] * n), "articles": pa.array([2] * n),
        "vector": pa.array((rng.random((n, 4)) + 5).tolist(), pa.list_(pa.float32())),
        "own": pa.array([[{"approvedClass": i, "approvedLoad": 1, "selves": 2}] if own else None for i in range(n)],
                        pa.list_(pa.struct([(c, pa.int64()) for c in ("approvedClass", "approvedLoad", "selves")]))),
    })


def test_matches_of_a_block_leave_in_parts(monkeypatch):
    """Each of a million pairs matches; no more than the scores held at once are held as matches."""
    monkeypatch.setattr(similarity, "_CELLS", 1 << 15)
    parts = [t.num_rows for t in similarity.block_matches(0.5)(block(1000, False))(block(1000, True))]
    assert sum(parts) == 1_000_000 and max(parts) <= 1 << 15
    some = similarity.block_matches(0.5)(block(1000, False))(block(1000, True).slice(3, 1))
    assert [i for t in some for i, n in enumerate(t["selves"].to_pylist()) if n] == [3]


def test_high_counts_leave_a_block_as_one_row_of_a_class(monkeypatch):
    monkeypatch.setattr(similarity, "_CELLS", 1 << 15)
    parts = list(similarity.block_best(0.5)(block(1000, False))(block(1000, False)))
    assert sum(t.num_rows for t in parts) == 1000
    assert {(r["newClass"], r["high"], r["approvedClass"]) for t in parts for r in t.to_pylist()} == {(i, 2000, i) for i in range(1000)}


def test_blocks_longer_than_a_batch(spark):
    roster, vectors = frames(spark, groups(4) + ODD)
    expected = rows(similar_pairs(roster, vectors, 0.8))
    full = {tuple(r) for r in similarity_report(roster, vectors, 0.8, True).drop("total", "best").collect()}
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        assert rows(similar_pairs(roster, vectors, 0.8, 50)) == rows(pivot_pairs(roster, vectors, 0.8, 5, 50)) == expected
        assert {tuple(r) for r in similarity_report(roster, vectors, 0.8, True, 50).drop("total", "best").collect()} == full
    finally:
        spark.conf.set(key, before)
