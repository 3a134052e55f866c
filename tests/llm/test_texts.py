"""Operators that work row by row: licences, languages, quality, tokens."""

import base64
import hashlib
import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import Window
from pyspark.sql import functions as F

from echowire.llm import bpe_tree, kernel_language, license_scan, rule_quality
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def rows_of(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_license_base_against_words(spark, documents, odd_rows):
    texts = [*odd_rows, (20, "CC-BY cc by. All rights reserved; GNU General Public License"), (21, "cc by" * 3)]
    texts += [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = license_scan.license_scan(documents(texts)).collect()
    assert len(found) == len(texts)
    expected = []
    for doc, text in texts:
        words = brute.licence_words(text)
        starts = {label: brute.phrase_starts(words, p) for p, label in license_scan.BASE.items()}
        every = sorted(x for s in starts.values() for x in s)
        expected.append((doc, len(words), len(every), every[0] if every else None, every[-1] if every else None,
                         ",".join(sorted(k for k, s in starts.items() if s))))
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) <= {*r.labels.split(","), ""} for r in found)


@pytest.mark.parametrize("text, postfix, accepted", [
    ("MIT", "mit", True),
    ("MIT OR GPL-2.0 AND GPL-3.0", "mit gpl-2.0 gpl-3.0 and or", True),
    ("(MIT OR GPL-2.0) AND GPL-3.0", "mit gpl-2.0 or gpl-3.0 and", False),
    ("Apache-2.0 WITH LLVM-exception AND MIT", "apache-2.0 llvm-exception with mit and", True),
    ("MIT is our choice", "mit", True),
    ("MIT AND", None, None),
    ("(MIT", None, None),
    ("OR MIT", None, None),
    ("", None, None),
])
def test_license_expressions(text, postfix, accepted):
    found = license_scan.to_postfix(text)
    assert (" ".join(found) if found else None) == postfix
    if found:
        assert license_scan.evaluate(found) is accepted


def test_license_tags(documents):
    row = license_scan.license_scan(documents([(1, "// SPDX-License-Identifier: MIT OR GPL-2.0\ncode")])).first()
    assert row.labels == "spdx:gpl-2.0,spdx:mit" and row.expressions == ["mit gpl-2.0 or"] and row.accepted


def test_license_ids_are_looked_up(documents):
    texts = {
        1: "SPDX-License-Identifier: see the file", 2: "the creative commons of ideas", 3: "SPDX-License-Identifier: (GPL-2.0+ WITH Classpath-exception-2.0)",
        4: "SPDX-License-Identifier: LicenseRef-Own AND Nothing-1.0", 5: "SPDX-License-Identifier: MIT WITH made-up", 6: "SPDX-License-Identifier: (MIT",
    }
    found = {r.doc_id: r for r in license_scan.license_scan(documents(list(texts.items()))).collect()}
    assert (found[1].labels, found[1].score, found[1].accepted) == ("spdx:unknown", 0.2, False)
    assert (found[2].labels, found[2].score) == ("cc", 0.3)
    assert found[3].labels == "spdx:gpl-2.0+" and found[3].score == 0.95
    assert found[4].labels == "spdx:licenseref-own,spdx:unknown"
    assert found[5].labels == "spdx:mit,spdx:unknown" and found[5].accepted
    assert (found[6].labels, found[6].accepted) == ("spdx:invalid", None)


@pytest.fixture(scope="module")
def codec():
    path, pattern = bpe_tree.vocabulary()
    return bpe_tree.Codec(bpe_tree.read_ranks(path), pattern, leaf=40, window=2)


def test_bpe_equals_the_library(codec):
    made = random.Random(5)
    parts = [" ", "\n", "\t", " ", "\x1c", "'", "'s", "'ll", "é", "日本", "12", "!?", "word", " word", "  ", "👍", "x" * 30]
    for _ in range(2000):
        text = "".join(made.choice(parts) for _ in range(made.randint(0, 120)))
        codec.leaf, codec.window = made.choice([1, 3, 40]), made.choice([2, 9])
        ids = codec.encode(text)
        assert ids == codec.encoding.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_most_given_documents_are_joined_and_equal_the_library(spark):
    path, pattern = bpe_tree.vocabulary()
    codec = bpe_tree.Codec(bpe_tree.read_ranks(path), pattern)
    joined, found = 0, spark.read.parquet(f"{SF}/documents.parquet").collect()
    for row in found:
        before = codec.joins
        ids = codec.encode(row.text or "")
        assert ids == codec.encoding.encode_ordinary(row.text or "") and codec.decode(ids).decode() == (row.text or "")
        joined += codec.joins > before
    assert joined > 0.8 * len(found)


def test_bpe_places_that_stay():
    """Borders in every place of texts made of digits, letters, punctuation and blanks."""
    path, pattern = bpe_tree.vocabulary()
    rng = random.Random(8)
    codec = bpe_tree.Codec(bpe_tree.read_ranks(path), pattern, leaf=1, window=2)
    for _ in range(150):
        text = "".join(rng.choice(["'s", "'", "ll", "a1", "12", " ", "  ", "\n", ".", "é", "，", "中文", "_", "A", "'re", "½", "\u0301"]) for _ in range(30))
        assert codec.encode(text) == codec.encoding.encode_ordinary(text), text


def test_bpe_round_trip_and_digests(documents, odd_rows):
    path, pattern = bpe_tree.vocabulary()
    docs = documents(odd_rows)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for doc, text in odd_rows:
        ids = plain.encode_ordinary(text or "")
        expected.append((doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256((text or "").encode()).hexdigest()))
    found = bpe_tree.digests(docs, path, pattern, leaf=1000, with_ids=True)
    got = rows_of(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert all(len(r.ids) == r.n_tokens for r in found.collect())
    back = bpe_tree.decode(bpe_tree.encode(docs, path, pattern), path, pattern)
    assert sorted(bytes(r.bytes).decode() for r in back.collect()) == sorted(t or "" for _, t in odd_rows)


def test_language_sample_is_the_first_by_hash(spark):
    """Many ids, few ids, and ids that repeat so often that their part of the hashes is too small."""
    rows = [(i, "many") for i in range(4000)] + [(i, "few") for i in range(5000, 5030)] + [(i % 60, "repeated") for i in range(3000)]
    known = spark.createDataFrame(rows, "doc_id long, lang string").repartition(4)
    got = sorted(rows_of(kernel_language.picked_ids(known, 50), "lang", "place", "doc_id"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    plain = known.distinct().withColumn("place", F.row_number().over(order)).where("place <= 50")
    assert got == sorted(rows_of(plain, "lang", "place", "doc_id"))
    assert [sum(g[0] == n for g in got) for n in ("few", "many", "repeated")] == [30, 50, 50]


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = kernel_language.predicted(docs, kernel_language.train(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert held > 0.97
    assert found.where("score < 0 OR score > 1").count() == 0


def test_language_cases(spark, documents, odd_rows):
    known = spark.createDataFrame(
        [(i, ("the of and that " if i % 2 else "der die und nicht ") * 5, "en" if i % 2 else "de") for i in range(40)],
        "doc_id long, text string, lang string")
    model = kernel_language.train(known)
    got = {(r.doc_id, r.lang_pred) for r in kernel_language.predicted(documents(odd_rows), model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (9, "und"), (11, "und")} <= got
    assert {p for _, p in got} <= {"und", "en", "de"}
    assert kernel_language.train(known.limit(0)) is None
    assert {r.lang_pred for r in kernel_language.predicted(documents(odd_rows), None).collect()} == {"und"}
    assert kernel_language.predicted(documents([]), model).count() == 0


def test_language_kernel_is_exact():
    a, b = "ab abc", "abcd"
    grams = [{x.encode()[i : i + n] for n in (1, 2, 3) for i in range(len(x) - n + 1)} for x in (a, b)]
    rows = kernel_language.presences([a, b])
    assert rows[0] @ rows[1] == len(grams[0] & grams[1])
    long = "xyz " * 400_000  # longer than one piece
    assert (kernel_language.presences([long]) == kernel_language.presences(["xyz " * 3])).all()


def test_quality_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = rule_quality.scored(docs, labels).join(labels, "doc_id").where("held_out")
    right = found.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right > 0.97
    kept = rule_quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    good = rule_quality.scored(docs, labels).where("predicted = 1")
    assert kept.count() == good.count() == kept.join(good, "doc_id", "left_semi").count()


def test_quality_cases(spark, documents, odd_rows):
    docs = documents(odd_rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = rule_quality.scored(docs, none).collect()
    assert len(found) == len(odd_rows) and {(r.score, r.predicted) for r in found} == {(0.5, 1)}
    odd = spark.createDataFrame([(1, None, 0), (None, 1, 0), (4, 7, 0), (6, 1, 1)], "doc_id long, quality int, toxic int")
    assert rule_quality.scored(docs, odd).where("score BETWEEN 0 AND 1").count() == len(odd_rows)
    assert rule_quality.scored(documents([]), none).count() == 0
    assert len(rule_quality.statistics(b"")) == len(rule_quality.STATISTICS)
    clash = docs.withColumn("letters", F.lit("x")).withColumn("__row", F.lit(1))
    assert rule_quality.keep_good(clash, none).columns == clash.columns


def test_rules_compile_to_the_same_scores(spark):
    made = np.random.default_rng(1)
    x = made.random((400, len(rule_quality.STATISTICS)))
    y = ((x[:, 3] > 0.5) & (x[:, 5] < 0.7)).astype(float)
    model = rule_quality.fit(x, y)
    assert 0 < len(model.rules) < 200
    margin = model.intercept + sum(w * rule_quality.holds(x, r) for r, w in zip(model.rules, model.weights))
    frame = spark.createDataFrame([tuple(map(float, r)) for r in x], list(rule_quality.STATISTICS))
    got = np.array([r.s for r in frame.select(model.score().alias("s")).collect()])
    assert np.allclose(np.sort(got), np.sort(1 / (1 + np.exp(-margin))))
    assert (((1 / (1 + np.exp(-margin))) > 0.5) == (y > 0.5)).mean() > 0.95
