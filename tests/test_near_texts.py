import os
import random
import re
from urllib.parse import urlparse

import pytest

from echowire.operators import near_texts

SCHEMA = "id long, articleId long, headline string, text string, classId string"


def approvals(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)


def normal(text):
    return " ".join(re.findall("[a-z0-9]+", (text or "").lower()))


def shingle_set(headline, text, width=5):
    words = f"{normal(headline)} {normal(text)}".split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, percent=75, width=5):
    """classId of each article, and the similar pairs of classes with their counts."""
    first = {}
    for row in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        first.setdefault(row[1], row)
    classes = {}
    for article, (_, _, headline, text) in first.items():
        classes.setdefault((normal(headline), normal(text)), []).append(article)
    members = {a: min(held) for held in classes.values() for a in held}
    sets = {min(held): (shingle_set(*key, width), len(held)) for key, held in classes.items()}
    pairs = {}
    for a in sets:
        for b in sets:
            common = len(sets[a][0] & sets[b][0])
            either = len(sets[a][0] | sets[b][0])
            if a < b and common and 100 * common >= percent * either:
                pairs[a, b] = (common, len(sets[a][0]), len(sets[b][0]), sets[a][1] * sets[b][1])
    return members, pairs


def found(spark, rows, percent=75, width=5):
    df = approvals(spark, rows).repartition(5)
    listed = near_texts.near_text_pairs(df, percent, width).collect()
    pairs = {(r.classId, r.otherId): (r.common, r["size"], r.otherSize, int(r.pairs)) for r in listed}
    assert len(pairs) == len(listed)
    for r in listed:
        assert r.similarity == r.common / (r["size"] + r.otherSize - r.common)
    members = {r.articleId: r.classId for r in near_texts.text_classes(df).collect()}
    return members, pairs


def texts(seed, groups=12, copies=7, length=40):
    """Groups of texts that differ in a few words each, with a shared notice and exact copies."""
    rng, rows = random.Random(seed), []
    words = [f"w{i}" for i in range(60)]
    for group in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([3, 6, length, 3 * length]))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                text[rng.randrange(len(text))] = rng.choice(words)
            if rng.random() < 0.3:
                text += "this notice stands below a third of all texts here".split()
            rows.append((len(rows), 500 - len(rows), f"Head {group % 3}", ", ".join(text)))
    return rows


@pytest.mark.parametrize("percent, width", [(75, 5), (50, 2)])
def test_pairs_equal_brute_force(spark, percent, width):
    rows = texts(percent)
    assert found(spark, rows, percent, width) == brute(rows, percent, width)


def test_small_blocks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(near_texts, "BLOCK_BITS", 1)
    monkeypatch.setattr(near_texts, "SET_BYTES", 400)
    rows = texts(4, groups=4, copies=20)
    assert found(spark, rows) == brute(rows)


def test_frequent_shingles_and_hot_keys(spark, monkeypatch):
    """Every text has the same notice; most articles are copies of one text."""
    monkeypatch.setattr("echowire.operators.skew.HOT_KEYS", 2)
    notice = "all of the texts in this table end with one and the same notice of twenty words " * 2
    rows = [(i, i, None, f"only {i} {i * 7} {i * 11} here {notice}") for i in range(60)]
    rows += [(100 + i, 100 + i, "Copy", "the same text as many others have it") for i in range(150)]
    rows += [(300, 300, "Copy", "the same text as many others have it now")]
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"word{i % 977}x{i}" for i in range(20_000))
    rows = [
        (1, 1, None, None), (2, 2, "", ""), (3, 3, "é", "中文"), (4, 4, "One", "two"), (5, 5, "one", "Two!"), (6, 5, "other", "text"),
        (7, 6, "", long), (8, 7, "", long + " end"), (9, None, "no", "article"), (None, 8, "no", "approval"), (10, 9, "one two", ""),
    ]
    members, pairs = found(spark, rows)
    assert (members, pairs) == brute(rows)
    assert members[4] == members[5] == 4 and (6, 7) in pairs and (4, 9) in pairs
    assert found(spark, []) == ({}, {})


def test_report(spark):
    rows = texts(9)
    members, pairs = brute(rows)
    size = {c: list(members.values()).count(c) for c in members.values()}
    links = {a: set() for a in size}
    for a, b in pairs:
        links[a].add(b)
        links[b].add(a)
    for r in near_texts.near_text_report(approvals(spark, rows)).collect():
        own = links[members[r.articleId]]
        assert (r.classId, r.copies) == (members[r.articleId], size[members[r.articleId]] - 1)
        assert r.nearMatches == sum(size[c] for c in own) and (r.bestId in own if own else r.bestId is None)


def test_percent_is_checked(spark):
    with pytest.raises(ValueError):
        near_texts.near_class_pairs(approvals(spark, []), 0)


def test_small_parts_lose_nothing(spark, monkeypatch):
    """Groups that end in any place of a batch, pairs dropped when repeated, and sets looked up in small parts."""
    for name, value in {"BLOCK_BITS": 2, "SET_BYTES": 900, "PREFIX_ROWS": 16, "HELD_PAIRS": 24, "GROUP_PAIRS": 9, "LOOKUPS": 60}.items():
        monkeypatch.setattr(near_texts, name, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    rows = texts(5, groups=4, copies=20)
    try:
        assert found(spark, rows) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_shingles_of_one_text_are_not_written(spark, monkeypatch):
    """What is written between the steps is less than the hashes of all shingles, of which nearly none are shared."""
    written, whole = [], near_texts.stored

    def measured(df, name):
        made = whole(df, name)
        written.extend(os.path.getsize(urlparse(f).path) for f in made.inputFiles())
        return made

    monkeypatch.setattr(near_texts, "stored", measured)
    rows = [(i, i, None, " ".join(f"word{i}x{j}" for j in range(3000))) for i in range(20)]
    rows.append((20, 20, None, rows[0][3] + " end"))
    assert found(spark, rows) == brute(rows)
    assert 0 < sum(written) < 8 * 20 * 3000
