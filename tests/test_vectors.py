import numpy as np
import pytest
from pyspark.sql import functions as F

from echowire.functions.vectors import cosine_score

NAN = float("nan")


def test_pair_scores(spark):
    rows = [
        ([1.0, 0.0], [1.0, 0.0], 1.0),
        ([1.0, 0.0], [0.0, 1.0], 0.0),
        ([1.0, 0.0], [-1.0, 0.0], 0.0),
        ([0.0, 0.0], [1.0, 0.0], 0.0),
        ([NAN, 0.0], [1.0, 0.0], 0.0),
        ([3.0, 4.0], [4.0, 3.0], 0.96),
        ([1.0, 2.0, 2.0], [2.0, 1.0, 2.0], 8 / 9),
        ([], [], 0.0),
        ([1.0], [1.0, 0.0], None),
        (None, [1.0], None),
        ([1.0, None], [1.0, 1.0], None),
        ([5.0, 0.0], [0.5, 0.0], 1.0),
    ]
    df = spark.createDataFrame(rows, "a array<float>, b array<float>, expected double")
    got = df.select(
        "expected",
        cosine_score(F.col("a"), F.col("b")).alias("ab"),
        cosine_score(F.col("b"), F.col("a")).alias("ba"),
    ).collect()
    for row in got:
        assert row.ab == row.ba
        assert row.ab == (None if row.expected is None else pytest.approx(row.expected, abs=1e-12))


def test_no_rows(spark):
    df = spark.createDataFrame([], "a array<float>, b array<float>")
    assert df.select(cosine_score(F.col("a"), F.col("b"))).count() == 0


def test_similar_pairs_hold_copies_as_classes(spark):
    """Thousands of copies of one vector are one class; every pair of different articles is counted."""
    from echowire.operators.similarity import class_members, similar_pairs

    made = np.random.default_rng(2)
    base = [[float(x) for x in v] for v in made.standard_normal((12, 6))]
    rows = [(i, base[0] if i < 3000 else base[i % 12]) for i in range(3060)] + [(9000, None), (9001, [0.0] * 6), (9002, [1.0])]
    vectors = spark.createDataFrame(rows, "articleId bigint, embedding array<double>")
    roster = vectors.select("articleId", F.expr("if(articleId % 7 = 0, null, cast(articleId % 3 as int))").alias("newLoad"),
                            F.expr("if(articleId % 5 = 0, null, cast(articleId % 2 as int))").alias("approvedLoad"))
    found = similar_pairs(roster, vectors, 0.5).collect()
    members = {}
    for r in class_members(roster, vectors).collect():
        members.setdefault((r.role, r.load, r.classId), []).append(r.articleId)
    assert len(found) < 300
    listed = {}
    for r in found:
        ids = [(n, a) for n in members[("new", r.newLoad, r.newClass)] for a in members[("approved", r.approvedLoad, r.approvedClass)] if n != a]
        assert len(ids) == r.pairs
        if len(ids) < 5000:
            listed.update({p: r.similarity for p in ids})
    plain = {i: v for i, v in rows if v and len(v) == 6 and any(v) and i >= 2990}
    loads = {r.articleId: (r.newLoad, r.approvedLoad) for r in roster.collect()}
    for n, v in plain.items():
        for a, w in plain.items():
            x, y = np.array(v), np.array(w)
            cosine = x @ y / np.linalg.norm(x) / np.linalg.norm(y)
            exists = n != a and loads[n][0] is not None and loads[a][1] is not None and loads[a][1] <= loads[n][0]
            if min(n, a) >= 3000 and abs(cosine - 0.5) > 1e-9 and v != base[0] and w != base[0]:
                assert ((n, a) in listed) == (exists and cosine > 0.5)


def test_encoder_gets_bounded_parts(spark, monkeypatch):
    """Long texts reach the encoder in parts of bounded size, in order; null and empty texts never do."""
    from echowire.functions import vectors

    monkeypatch.setattr(vectors, "PIECE_BYTES", 1000)
    texts = ["é" * 30 * (i % 7) for i in range(100)] + [None, "x" * 5000, "", "é" * 500, "y"]

    def load_encoder():
        def encode(part):
            assert all(part) and (len(part) == 1 or sum(len(t.encode()) for t in part) <= 1000)
            return np.array([[len(t), t.count("y")] for t in part])

        return encode

    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string").coalesce(1)
    got = df.select("i", vectors.encoded(F.col("t"), load_encoder, 2).alias("v")).collect()
    assert {r.i: r.v for r in got} == {i: [float(len(t or "")), float((t or "").count("y"))] for i, t in enumerate(texts)}
