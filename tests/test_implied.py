"""The figures from counts must equal those of the pairs written out one by one."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from echowire.operators import implied
from echowire.operators.similarity import similarity_progress, similarity_report
from echowire.sources.intake_log import load_rows, roster


class Brute:
    """Loads applied pair by pair to a set."""

    def __init__(self):
        self.pairs = set()

    def load(self, new, approved):
        before = len(self.pairs)
        self.pairs |= {(n, a) for n in new for a in approved}
        return len(self.pairs) - before


def _ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "articleId bigint")


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(7)
    keys = {i: ("hot" if i % 3 == 0 else f"k{rng.randrange(25)}" if i % 7 else None) for i in range(60)}
    keys = {i: k for i, k in keys.items() if i % 11}  # some articles have no feature row
    brute, log, results = Brute(), spark.createDataFrame([], "articleId bigint, role string, load int"), []
    loads = [
        (range(0, 20), range(10, 30)),
        (range(15, 25), range(10, 45)),
        (range(0, 5), range(10, 45)),
        ([], range(10, 60)),
        ([55, 56], range(10, 60)),
    ]
    for number, (new, approved) in enumerate(loads, start=1):
        new_ids, approved_ids = _ids(spark, new), _ids(spark, approved)
        added = load_rows(log, new_ids, approved_ids, number)
        results.append((implied.load_result(log, added, approved_ids).first(), brute.load(new, approved),
                        len(new), len(approved), len(brute.pairs)))
        log = spark.createDataFrame(log.unionByName(added).collect(), log.schema)
    features = spark.createDataFrame(list(keys.items()), "articleId bigint, key string")
    return roster(log).cache(), features.cache(), keys, brute.pairs, results


def test_load_results(case):
    for row, new_pairs, listed, approved, total in case[4]:
        assert (row.new_pairs, row.total_pairs) == (new_pairs, total)
        assert row.existing_pairs == listed * approved - new_pairs
        assert (row.csv_articles_loaded, row.approved_articles) == (listed, approved)


def test_pair_stats(case):
    ros, _, _, pairs, _ = case
    row = implied.pair_stats(ros).first()
    assert row.total_pairs == len(pairs)
    assert row.unique_new_articles == len({n for n, _ in pairs})
    assert row.unique_approved_articles == len({a for _, a in pairs})


def test_progress(case):
    ros, features, keys, pairs, _ = case
    done = [(n, a) for n, a in pairs if n in keys and a in keys]
    matching = [p for p in done if keys[p[0]] is not None and keys[p[0]] == keys[p[1]]]
    for report, prefix, name in (
        (implied.url_progress, "url_check", "matching_urls"),
        (implied.content_progress, "content_hash", "matching_content"),
    ):
        row = report(ros, features).first()
        assert row.total_pairs == len(pairs)
        assert row[f"{prefix}_completed"] == len(done)
        assert row[f"{prefix}_pending"] == len(pairs) - len(done)
        assert row[name] == len(matching)


@pytest.mark.parametrize("exclude_self", [False, True])
def test_match_report(case, exclude_self):
    ros, features, keys, pairs, _ = case
    partners = defaultdict(set)
    for n, a in pairs:
        if keys.get(n) is not None and keys.get(n) == keys.get(a) and not (exclude_self and n == a):
            partners[n].add(a)
    got = {r.articleId: r for r in implied.match_report(ros, features, exclude_self).collect()}
    assert {n: r.matches for n, r in got.items()} == {n: len(a) for n, a in partners.items()}
    for n, row in got.items():
        assert row.partnerId in partners[n]
        if not exclude_self:
            assert row.partnerId == min(partners[n])


def test_members_give_back_every_match(case):
    ros, features, keys, pairs, _ = case
    rows = implied.match_members(ros, features).collect()
    rebuilt = {
        (n.articleId, a.articleId)
        for n in rows for a in rows
        if n.key == a.key and n.newLoad and a.approvedLoad and a.approvedLoad <= n.newLoad
    }
    assert rebuilt == {(n, a) for n, a in pairs if keys.get(n) is not None and keys.get(n) == keys.get(a)}
    assert len(rows) == len({r.articleId for r in rows})


def test_empty_log(spark):
    empty = roster(spark.createDataFrame([], "articleId bigint, role string, load int"))
    features = spark.createDataFrame([], "articleId bigint, key string")
    row = implied.url_progress(empty, features).first()
    assert (row.total_pairs, row.url_check_completed, row.matching_urls) == (0, 0, 0)
    assert (row.completion_percentage, row.match_percentage) == (0.0, 0.0)
    assert implied.match_report(empty, features).count() == 0


def _cosine(a, b):
    """Score of two vectors, None for a failure."""
    if a is None or b is None or len(a) != len(b) or None in a or None in b:
        return None
    a, b = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
    norms = np.linalg.norm(a) * np.linalg.norm(b)
    score = 0.0 if norms == 0 else float(a @ b / norms)
    return score if score > 0 else 0.0


@pytest.mark.parametrize("exclude_self,block_rows", [(False, 16384), (True, 7), (False, 7)])
def test_similarity_equals_brute_force(spark, case, exclude_self, block_rows):
    ros, _, _, pairs, _ = case
    rng = np.random.default_rng(3)
    vectors = {i: rng.normal(size=4).astype(np.float32).tolist() for i in range(60)}
    for i in range(0, 60, 3):
        vectors[i] = [1.0, 2.0, 3.0, 4.0]  # copies
    vectors.update({4: [0.0] * 4, 7: [float("nan")] * 4, 10: None, 14: [1.0, 2.0], 17: [1.0, None, 0.0, 0.0], 20: []})
    del vectors[23]
    table = spark.createDataFrame(list(vectors.items()), "articleId bigint, embedding array<float>")
    report = similarity_report(ros, table, 0.8, exclude_self, block_rows)
    got = {r.articleId: r for r in report.collect()}

    scores = defaultdict(dict)
    for n, a in pairs:
        if n in vectors and a in vectors and not (exclude_self and n == a):
            scores[n][a] = _cosine(vectors[n], vectors[a])
    assert {n for n, r in got.items() if r.compared} == set(scores)
    for n, by_id in scores.items():
        row, valid = got[n], {a: s for a, s in by_id.items() if s is not None}
        assert (row.compared, row.failed) == (len(by_id), len(by_id) - len(valid))
        assert row.high == sum(s > 0.8 for s in valid.values())
        assert row.total == pytest.approx(sum(valid.values()), abs=1e-9)
        if valid:
            assert row.best == pytest.approx(max(valid.values()), abs=1e-9)
            assert row.bestId == min(a for a, s in valid.items() if round(s, 9) == round(row.best, 9))
        else:
            assert row.best is None and row.bestId is None

    flat = [s for by_id in scores.values() for s in by_id.values()]
    good = [s for s in flat if s is not None]
    row = similarity_progress(ros, report).first()
    assert row.total_pairs == len(pairs)
    assert row.embedding_search_completed == len(flat)
    assert row.total_errors == len(flat) - len(good)
    assert row.high_similarity_pairs == sum(s > 0.8 for s in good)
    assert row.avg_similarity_score == pytest.approx(sum(good) / len(flat), abs=1e-9)
    assert row.overall_avg_similarity == pytest.approx(sum(good) / len(good), abs=1e-9)
