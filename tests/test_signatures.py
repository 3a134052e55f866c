"""Overlap of states and proximity of dates against plain loops."""

import datetime
import random

import pytest

from echowire.operators import date_proximity, state_overlap

PAIRS = "articleIdNew long, articleIdApproved long, note string"


def test_state_overlap_equals_sets(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(40), rng.choice([0, 1, 63, 64, 65, 127, 128, 1000, 5, -1, -64])) for _ in range(300)]
    rows += [(7, 3)] * 50 + [(None, 1), (8, None), (99, None)]
    pairs = [(rng.randrange(45), rng.randrange(45), "x") for _ in range(200)] + [(7, 7, "x"), (7, None, "x"), (None, None, "x")]
    states = {}
    for article, state in rows:
        if article is not None and state is not None:
            states.setdefault(article, set()).add(state)
    bitmaps = state_overlap.state_bitmaps(spark.createDataFrame(rows, "articleId long, stateId int"))
    for r in bitmaps.collect():
        assert r.states == len(states[r.articleId])
        assert {64 * w + b for w, bits in r.words.items() for b in range(64) if bits >> b & 1} == states[r.articleId]
    scored = state_overlap.state_overlap(spark.createDataFrame(pairs, PAIRS), bitmaps)
    got = sorted(((r.articleIdNew, r.articleIdApproved, r.commonStates, r.signatureMatchState) for r in scored.collect()), key=repr)
    expected = []
    for a, b, _ in pairs:
        x, y = states.get(a), states.get(b)
        expected.append((a, b, len(x & y), len(x & y) / len(x | y)) if x and y else (a, b, None, None))
    assert got == sorted(expected, key=repr)
    done = [e[3] for e in expected if e[3] is not None]
    row = state_overlap.state_progress(scored).first()
    assert (row.total_pairs, row.state_completed, row.state_pending) == (len(expected), len(done), len(expected) - len(done))
    assert row.equal_states == done.count(1.0) and row.avg_overlap == pytest.approx(sum(done) / len(done))


def test_no_states(spark):
    bitmaps = state_overlap.state_bitmaps(spark.createDataFrame([], "articleId long, stateId int"))
    scored = state_overlap.state_overlap(spark.createDataFrame([(1, 2, "x")], PAIRS), bitmaps)
    assert scored.first().signatureMatchState is None
    assert state_overlap.state_progress(scored).first().avg_overlap == 0.0


def day(n):
    return datetime.datetime(1970, 1, 1, 13, 30) + datetime.timedelta(days=n)


@pytest.mark.parametrize("window", [1, 2, 7, 30])
def test_dates_equal_plain_loops(spark, window):
    rng = random.Random(window)
    dates = {i: rng.choice([0, 0, 0, rng.randrange(-40, 40), rng.randrange(-400, 400)]) for i in range(150)}
    loads = {i: (rng.choice([None, 1, 2, 3]), rng.choice([None, 1, 2, 3])) for i in dates}
    rows = [(i, day(n)) for i, n in dates.items()] + [(5, day(dates[5] + 90)), (None, day(1)), (200, None)]
    days = date_proximity.day_features(spark.createDataFrame(rows, "articleId long, date timestamp"))
    assert {r.articleId: r.day for r in days.collect()} == dates
    roster = spark.createDataFrame([(i, *x) for i, x in loads.items()], "articleId long, newLoad int, approvedLoad int")
    near = {}
    for n in dates:
        for a in dates:
            if loads[n][0] and loads[a][1] and loads[a][1] <= loads[n][0] and abs(dates[n] - dates[a]) < window:
                near.setdefault(n, []).append((abs(dates[n] - dates[a]), a))
    report = date_proximity.date_report(roster, days, window).collect()
    assert {r.articleId: (r.nearDates, r.days, r.nearestId) for r in report} == {n: (len(x), *min(x)) for n, x in near.items()}
    assert len(report) == len(near)
    matches = date_proximity.day_matches(roster, days, window)
    row = date_proximity.date_progress(matches).first()
    apart = [d for x in near.values() for d, _ in x]
    assert (int(row.near_pairs), int(row.same_day_pairs)) == (len(apart), apart.count(0))
    assert row.proximity_sum == pytest.approx(sum(1 - d / window for d in apart))
    keys = [(r.newDay, r.newLoad, r.approvedDay, r.approvedLoad) for r in matches.collect()]
    assert len(keys) == len(set(keys))


def test_date_scores_of_pairs(spark):
    days = date_proximity.day_features(spark.createDataFrame([(1, day(0)), (2, day(3)), (3, day(50))], "articleId long, date timestamp"))
    pairs = spark.createDataFrame([(1, 2, "x"), (1, 3, "x"), (1, 1, "x"), (1, 9, "x"), (None, 1, "x")], PAIRS)
    got = {(r.articleIdNew, r.articleIdApproved): r.signatureMatchDate for r in date_proximity.date_scores(pairs, days, 6).collect()}
    assert got == {(1, 2): 0.5, (1, 3): 0.0, (1, 1): 1.0, (1, 9): None, (None, 1): None}
    with pytest.raises(ValueError):
        date_proximity.date_scores(pairs, days, 0)
