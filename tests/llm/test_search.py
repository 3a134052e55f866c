"""Ranked search against a plain scan of all documents."""

import math
import re
from collections import Counter

import pytest

from echowire.llm import lexical_search as search

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return Counter(TERM.findall((text or "").translate(LOWER)))


def expected(docs, items, best=10):
    held = [(doc, terms(text)) for doc, text in docs]
    held = [(doc, t) for doc, t in held if t]
    n_docs, n_terms = len(held), sum(t.total() for _, t in held)
    df = Counter(term for _, t in held for term in t)
    out, wanted = {}, {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    for item, words in wanted.items():
        scored = []
        for doc, t in held:
            m = 100 - 90 + (90 * t.total() * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * t[w]) // (1000 * t[w] + 8 * m))
                for w in words if w in t
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for rank, (score, none, doc) in enumerate(sorted(scored)[:best], 1):
            out[item, rank] = (None if none else doc, -score)
    return out


def found(docs, items, **options):
    rows = search.ranked_search(docs, items, **options).collect()
    assert len(rows) == len({(r.item_id, r.rank) for r in rows})
    return {(r.item_id, r.rank): (r.doc_id, r.score) for r in rows}


DOCS = [
    (i, " ".join(["the"] * (1 + i % 3) + [f"w{i % 7}", f"W{i % 11}", f"r{i // 4}", "été" if i % 5 else "x_y-z"]) + "." * (i % 4))
    for i in range(400)
]
ITEMS = [(1, "The w3 W5 r12"), (2, "été r90 r91 r92 R93"), (3, "nothing-here"), (4, "the"), (5, "x y z the w1 w2 w3 w4"), (6, None),
         (7, ""), (None, "r3 r4"), (8, "r5"), (8, "r6 the"), (8, "r5")]


@pytest.mark.parametrize("shard, items_per_block", [(4096, 256), (16, 2)])
def test_equals_a_plain_scan(spark, documents, odd_rows, monkeypatch, shard, items_per_block):
    monkeypatch.setattr(search, "SHARD_DOCS", shard)
    monkeypatch.setattr(search, "ITEMS", items_per_block)
    rows = DOCS + [(i and i + 5000, t) for i, t in odd_rows]
    items = ITEMS + [(20, "word1 word976 one two"), (21, "a"), (22, "0" * 50_000)]
    items_df = spark.createDataFrame([(i, t, "en", 0) for i, t in items], "item_id long, text string, rank string, shard int")
    assert found(documents(rows).repartition(3), items_df) == expected(rows, items)


def test_drops_only_what_cannot_come_back(spark, documents, monkeypatch):
    monkeypatch.setattr(search, "RARITY", (300, 30, 3))
    rows = [(i, f"rare{i % 90} mid{i % 9} " + "common " * (1 + i % 4) + "all") for i in range(900)]
    items = [(i, f"rare{i} mid{i % 9} mid{(i + 1) % 9} common all") for i in range(12)]
    items_df = spark.createDataFrame(items, "item_id long, text string")
    assert found(documents(rows), items_df, best=3) == expected(rows, items, best=3)


def test_ties_and_repeated_rows(spark, documents):
    rows = [(9, "same words"), (3, "same words"), (3, "same words"), (None, "same words"), (1, "other")]
    got = found(documents(rows), spark.createDataFrame([(1, "same")], "item_id long, text string"))
    assert [got[1, i][0] for i in (1, 2, 3, 4)] == [3, 3, 9, None] and len(got) == 4


@pytest.mark.parametrize("rows, items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None), (2, "..")], [(1, "a")]), ([(1, "a")], [(1, "b")])])
def test_empty(spark, documents, rows, items):
    assert found(documents(rows), spark.createDataFrame(items, "item_id long, text string")) == {}


def test_long_texts_count_alike(monkeypatch):
    text = "Ab ab, É1 é1 ü ".encode() * 50
    whole = search.counted(text)
    monkeypatch.setattr(search, "LONG", 10)
    assert search.counted(text) == whole and whole[b"ab"] == 100
