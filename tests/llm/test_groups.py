"""Operators on the whole table: vectors, near copies, lines, personal data, test items, shards, and the pipeline."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from echowire.llm import (
    components, decontaminate, hilbert_shards, line_dedup, minhash_dedup, pairing, pii_sanitise, pstable_dedup, shingles,
)
from tests.llm import brute

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def given(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    return rows


def copies(made, n, words=60, changes=4):
    """Near copies of one text."""
    base = [f"w{made.randrange(5000)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(n - 1):
        text = list(base)
        for _ in range(made.randint(0, changes)):
            text[made.randrange(words)] = f"v{made.randrange(10**6)}"
        out.append(" ".join(text))
    return out


# ------------------------------------------------------------------ components


def test_components_of_chains_stars_and_loops(spark):
    made = random.Random(2)
    ids = list(range(400))
    made.shuffle(ids)
    edges = list(zip(ids[:150], ids[1:151])) + [(ids[200], x) for x in ids[201:300]] + [(5, 5), (None, 3)]
    union = brute.Union(range(400))
    for a, b in edges:
        if a is not None:
            union.join(a, b)
    found = {r.id: r.component for r in components.connected(spark.createDataFrame(edges, "src long, dst long")).collect()}
    touched = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    assert found == {x: union.find(x) for x in touched}
    assert components.connected(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_block_pairs_hold_each_pair_once(spark):
    rows = spark.range(50).select("id", F.lit(50).alias("n"))
    cut = pairing.block_pairs(rows, "n", "id", 8).groupBy("left", "right").agg(F.collect_list(F.struct("id", "block")).alias("m"))
    seen = []
    for r in cut.collect():
        for i, a in enumerate(r.m):
            for b in r.m[i + 1 :]:
                if (a.block != b.block) == (r.left != r.right):
                    seen.append((min(a.id, b.id), max(a.id, b.id)))
    assert sorted(seen) == [(a, b) for a in range(50) for b in range(a + 1, 50)]


# --------------------------------------------------------------------- vectors


def links_of(rows, cosine=0.98):
    rows = [(i, v, label) for i, v, label in rows]
    usable = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and any(v) and label is not None
              for _, v, label in rows]
    union, n = brute.Union([i for i, _, _ in rows]), {i: 0 for i, _, _ in rows}
    for x, (i, v, a) in enumerate(rows):
        for y, (j, w, b) in enumerate(rows[:x]):
            if usable[x] and usable[y] and a == b and len(v) == len(w):
                v_, w_ = np.array(v, float), np.array(w, float)
                if v_ @ w_ / np.linalg.norm(v_) / np.linalg.norm(w_) >= cosine:
                    n[i] += 1
                    n[j] += 1
                    union.join(i, j)
    return sorted((i, n[i], union.find(i), union.find(i) == i) for i in n)


def test_vectors_against_all_pairs(spark, monkeypatch):
    made = np.random.default_rng(4)
    centre = made.standard_normal((6, 16))
    rows = []
    for i in range(240):
        v = centre[i % 6] + made.normal(0, 0.05 + 0.1 * (i % 3), 16)
        rows.append((i, [float(x) for x in v], i % 2))
    rows += [(300 + i, rows[0][1], 0) for i in range(5)]  # equal vectors
    rows += [(400, None, 0), (401, [], 0), (402, [0.0] * 16, 0), (403, [float("nan")] * 16, 0), (404, [None] + [1.0] * 15, 0),
             (405, rows[0][1], None), (406, rows[0][1][:8], 0), (407, [float("inf")] + [1.0] * 15, 0), (408, [1e-200] * 16, 0),
             (409, [1e-200] * 16, 0)]
    monkeypatch.setattr(pstable_dedup, "BLOCK", 16)  # several blocks for one bucket
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("n_links", F.lit("x"))
    found = pstable_dedup.near_vectors(table)
    expected = links_of([r for r in rows if r[0] < 408])
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found.collect())
    assert [g for g in got if g[0] < 408] == expected
    assert [g for g in got if g[0] >= 408] == [(408, 1, 408, True), (409, 1, 408, False)]


def test_vectors_cases(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert pstable_dedup.near_vectors(empty).count() == 0
    odd = spark.createDataFrame([(None, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (1, [1.0, 2.0], 1)], empty.schema)
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in pstable_dedup.near_vectors(odd).collect()), key=str)
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (None, 0, None, False)]


# ----------------------------------------------------------------- near copies


def test_word_hashes_do_not_depend_on_place():
    made = random.Random(9)
    for _ in range(50):
        words = ["".join(made.choice("abcé!") for _ in range(made.randint(1, 9))) for _ in range(30)]
        gaps = ["".join(made.choice(" \n\t\r") for _ in range(made.randint(1, 3))) for _ in words]
        one = shingles.word_hashes(" ".join(words).encode())
        two = shingles.word_hashes("".join(g + w.upper().replace("É", "é") for g, w in zip(gaps, words)).encode())
        assert (one == two).all() and len(set(one.tolist())) == len(set(words))


def test_long_words_and_texts_keep_their_hashes(monkeypatch):
    text = " ".join(["short", "x" * 30_000, "tail"] * 5).encode()
    whole = shingles.word_hashes(text)
    parts = np.concatenate([shingles.word_hashes(w) for w in text.split()])
    assert (whole == parts).all()
    many = " ".join(f"word{i}" for i in range(400_000)).encode()  # several chunks
    assert len(many) > 2 * shingles.CHUNK
    found = shingles.word_hashes(many)
    assert len(found) == 400_000
    assert (found[::40_000] == np.concatenate([shingles.word_hashes(f"word{i}".encode()) for i in range(0, 400_000, 40_000)])).all()


def test_near_copies_against_all_pairs(spark, documents, given, odd_rows):
    made = random.Random(3)
    rows = [r for r in odd_rows if r[0] is not None] + [(1000 + d, t) for d, t in given[:300]]
    at = 5000
    for size, words, changes in ((40, 60, 4), (30, 20, 1), (25, 8, 1), (60, 200, 9), (12, 5, 1)):
        for text in copies(made, size, words, changes):
            rows.append((at, text))
            at += 1
    distinct = dict(rows)
    expected = brute.near_duplicates(distinct.items())
    found = minhash_dedup.near_duplicates(documents(rows).withColumn("component", F.lit("x"))).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == expected


def test_near_copies_without_a_common_original(spark, documents, monkeypatch):
    """A chain in which only neighbours are similar, and blocks smaller than its bands."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", 8)
    words = [f"w{i}" for i in range(400)]
    rows = [(100 - i, " ".join(words[4 * i : 4 * i + 100])) for i in range(60)]
    found = minhash_dedup.near_duplicates(documents(rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute.near_duplicates(rows)


def test_near_copies_cases(documents):
    assert minhash_dedup.near_duplicates(documents([])).count() == 0
    docs = documents([(None, "a b c d e f"), (1, "a b c d e f"), (2, None), (3, "A\nB c d e  f")])
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(docs).collect()), key=str)
    assert got == [(1, 2, 1, True), (2, 0, 2, True), (3, 2, 1, False), (None, 2, None, False)]
    assert sorted(r.doc_id for r in minhash_dedup.drop_near_duplicates(docs).collect()) == [1, 2]


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_one_of_all_rows_of_a_text_stays(documents, monkeypatch, broadcast):
    monkeypatch.setattr(minhash_dedup, "BROADCAST_IDS", broadcast)
    copies = [(1, "one text of some words"), (1, "one text of some words"), (2, "one text of some words"), (None, "one text of some words"), (None, "one text of some words")]
    alone = [(None, "nothing else is like this row"), (None, "nothing else is like this row"), (5, "row five"), (5, "row five"), (5, "the other row five"), (None, None), (None, "")]
    left = minhash_dedup.drop_near_duplicates(documents(copies + alone)).collect()
    got = sorted(((r.doc_id, r.text or "") for r in left), key=str)
    assert got == sorted([(1, copies[0][1]), (None, alone[0][1]), (5, "row five"), (5, "the other row five"), (None, "")], key=str)


def test_estimates_are_near_the_truth():
    made = np.random.default_rng(0)
    for size in (30, 300, 5000):
        base = np.unique(made.integers(0, 2**63, 2 * size, dtype=np.uint64))
        a, b = np.sort(base[:size]), np.sort(base[size // 4 : size + size // 4])
        truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        both = minhash_dedup.Sketches([minhash_dedup.registers(x).tobytes() for x in (a, b)], np.array([len(a), len(b)]))
        assert len(both.plausible(0, np.array([1]), int(truth * 100))) == 1
        assert len(both.plausible(0, np.array([1]), min(99, int(truth * 100) + 30))) == 0
        assert minhash_dedup.linked(a, b, int(truth * 100)) and not minhash_dedup.linked(a, b, int(truth * 100) + 2)


# ----------------------------------------------------------------------- lines


def test_lines_against_plain(spark, documents, given, odd_rows):
    rows = [r for r in odd_rows if r[0] is not None and r[0] != 5] + [(1000 + d, t) for d, t in given]
    rows += [(9000 + i, f"  Common Line \t\nown {i}\n\nCOMMON LINE\nrare" if i < 12 else f"rare\nown {i}") for i in range(20)]
    docs = documents(rows).withColumn("h1", F.lit(1))
    found = line_dedup.digests(docs, line_dedup.keep_bitmaps(docs)).collect()
    expected = brute.kept_lines(rows)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in found}
    assert got == {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for d, (n, k, t) in expected.items()}


def test_first_occurrence_may_stay(documents):
    rows = [(i, f"same line\nown {i}\nsame line") for i in range(12)] + [(50 + i, "all\nlines\nare here") for i in range(11)]
    docs = documents(rows)
    cleaned = {r.doc_id: r.text for r in line_dedup.drop_lines(docs, keep_first=True).collect()}
    assert cleaned == {0: "same line\nown 0", **{i: f"own {i}" for i in range(1, 12)}, 50: "all\nlines\nare here"}
    assert {r.doc_id: r.text for r in line_dedup.drop_lines(docs).collect()} == {i: f"own {i}" for i in range(12)}


def test_line_runs_across_partitions(spark):
    """A key that fills many partitions and batches is counted once per document."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(1, 1, d, 0, 3, [0]) for d in range(300)] + [(1, 1, 7, 0, 3, [1])] + [(k, 2, d, 0, 1, [0]) for k in range(2, 40) for d in range(k)]
        table = spark.createDataFrame(rows, "h1 long, h2 long, doc_id long, text_hash long, n_lines int, places array<int>")
        found = {r.h1: (r.n_docs, r.first_doc, r.first_at) for r in line_dedup.frequent_keys(table, 10).collect()}
        assert found == {1: (300, 0, 0), **{k: (k, 0, 0) for k in range(10, 40)}}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_line_cases(documents):
    docs = documents([])
    assert line_dedup.digests(docs, line_dedup.keep_bitmaps(docs)).count() == 0
    docs = documents([(1, "a\nb")] * 12 + [(None, "a\nb")])  # two documents, however often they are repeated
    got = {(r.doc_id, r.n_lines, r.n_dropped) for r in line_dedup.digests(docs, line_dedup.keep_bitmaps(docs)).collect()}
    assert got == {(1, 2, 0), (None, 2, 0)}
    keep = line_dedup.keep_bitmaps(docs, min_docs=2).collect()
    assert all(np.unpackbits(np.frombuffer(zlib.decompress(r.keep), np.uint8))[:2].sum() == 0 for r in keep)


# --------------------------------------------------------------- personal data


def test_pii_against_plain(spark, documents, given, odd_rows):
    made = random.Random(6)
    parts = ["a.b+c@mail.example.com", "@", ".", "-", "x@y", "x@y.z_w@v.u", "1.2.3.4", "256.1.1.1", "0001.02.3.255", "5.6.7.8.9.10.11.12",
             "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 1234-5678", "+1", "12 34", " ", "\n", "word", "é", "👍", "123456789012345678901234", "4111111111111111"]
    rows = [r for r in odd_rows if r[0] is not None and r[0] != 5] + [(1000 + d, t) for d, t in given]
    rows += [(9000 + i, "".join(made.choice(parts) for _ in range(made.randint(1, 25)))) for i in range(400)]
    found = pii_sanitise.digests(pii_sanitise.spans(documents(rows).withColumn("term", F.lit(1)))).collect()
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in found}
    expected = {}
    for doc, text in rows:
        spans = brute.pii(text)
        expected[doc] = (*(len(spans[k]) for k in brute.PII), brute.pii_hash(spans))
    assert got == expected


def test_pii_many_matches_in_one_text(documents):
    """A text of 100,000 addresses, some of them with a term between them."""
    text = " ".join(f"1.{i % 251}.{i % 7}.4" if i % 1000 else f"1.2.3.4 word{i}" for i in range(100_000))
    began = time.monotonic()
    row = pii_sanitise.digests(pii_sanitise.spans(documents([(1, text), (2, "a text")]))).where("doc_id = 1").first()
    assert row.n_ip == row.n_spans == 100_000 and row.base_sha256 == brute.pii_hash(brute.pii(text))
    assert row.sanitised_sha256 == hashlib.sha256(re.sub(r"1[.][0-9.]+", "[IP]", text).encode()).hexdigest()
    assert time.monotonic() - began < 100


def marked_terms(rows, found):
    return {r.doc_id: {dict(rows)[r.doc_id][s.start : s.end] for s in r.term} for r in found.collect()}


def test_telling_terms(documents):
    """A name that stands next to one address and nowhere else is taken out; common words are left."""
    rows = [(i, f"please write to Grenzmark office at boss@firm.example now, item {i}") for i in range(6)]
    rows += [(50 + i, f"please ring Weitblick now at +49 30 1234567, item {i}") for i in range(20)]
    rows += [(100 + i, f"please write to the office at once or ring and now, item {i}") for i in range(2000)]
    docs = documents(rows)
    got = marked_terms(rows, pii_sanitise.spans(docs))
    assert all(got[i] == {"Grenzmark"} for i in range(6)) and all(got[50 + i] == {"Weitblick"} for i in range(20))
    assert not any(got[i] for i in got if i >= 100)
    clean = {r.doc_id: r.text for r in pii_sanitise.sanitised(docs).collect()}
    assert clean[0] == "please write to [TERM] office at [EMAIL] now, item 0"
    assert clean[50] == "please ring  now at [PHONE], item 0" and clean[100] == dict(rows)[100]


def test_terms_need_several_texts(documents):
    """One text, however often it is copied, shows nothing; parts that several values share carry the evidence for each."""
    rows = [(i, f"the office is open on day {i % 9} in week {i} and at noon") for i in range(300)]
    rows += [(400, "the office of Grenzmark is at a.b@c.example and open"), (401, "the office is open on day 3, see +49 30 1234567")]
    rows += [(500 + i, rows[300][1]) for i in range(40)]
    assert not any(marked_terms(rows, pii_sanitise.spans(documents(rows))).values())

    rows += [(600 + i, f"the office is open, Nordhaus says, on day {i % 9} at x{i}@nordhaus.example") for i in range(8)]
    got = marked_terms(rows, pii_sanitise.spans(documents(rows)))
    assert all("Nordhaus" in got.pop(600 + i) for i in range(8)) and not any(got.values())


def test_marks_do_not_grow_with_the_table(documents):
    """Random words beside unrelated values stay, in a small and in a larger table; a planted name is found in both."""
    made = random.Random(8)
    for n in (300, 3000):
        words = [f"w{i}" for i in range(n)]
        rows = [(i, " ".join(made.choices(words, k=12)) + (f" u{i % (n // 30)}@m{i % 7}.example" if i % 10 == 0 else "")) for i in range(n)]
        rows += [(n + i, f"{' '.join(made.choices(words, k=8))} Grenzmark boss@firm.example") for i in range(3)]
        got = marked_terms(rows, pii_sanitise.spans(documents(rows)))
        assert all("Grenzmark" in got[n + i] for i in range(3))
        assert sum(map(len, got.values())) - 3 <= n // 100


def brute_disclosures(rows):
    """Marked terms of each row from all pairs of terms and entities of ASCII texts."""
    texts = sorted({t or "" for _, t in rows})
    entities, terms = {}, {}
    for text in texts:
        held, masked = set(), list(text)
        for kind, places in brute.pii(text).items():
            for a, b in places:
                value = text[a:b].lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", text[a:b])
                part = {"email": value.split("@")[-1], "ip": ".".join(value.split(".")[:3]), "card": value[:6], "phone": value[:5]}[kind]
                held |= {f"{kind}:{value}", f"{kind}-part:{part}", f"{kind}-any"}
                masked[a:b] = " " * (b - a)
        entities[text], terms[text] = held, {t.lower() for t in re.findall("[A-Za-z0-9]+", "".join(masked))}
    whole = {t: {w.lower() for w in re.findall("[A-Za-z0-9]+", t)} for t in texts}
    n_term, n_entity, n_near = Counter(), Counter(), Counter()
    for text in texts:
        n_term.update(whole[text])
        n_entity.update(entities[text])
        n_near.update((t, e) for t in terms[text] for e in entities[text])

    def disclosure(t, e):
        n, z, p = max(n_term[t], n_near[t, e]), pii_sanitise.TRUST**2, n_near[t, e] / max(n_term[t], n_near[t, e])
        low = (p + z / (2 * n) - (z * (p * (1 - p) / n + z / (4 * n * n))) ** 0.5) / (1 + z / n)
        return 1 - math.log(low) / math.log(max(n_entity[e] / len(texts), pii_sanitise.FLOOR))

    return {text: {
        t: "remove" if best >= pii_sanitise.REMOVE else "generalise" for t in terms[text]
        for best in [max((disclosure(t, e) for e in entities[text] if n_entity[e] < len(texts)), default=0)] if best >= pii_sanitise.GENERALISE
    } for text in texts}


def test_disclosures_against_plain(documents):
    made = random.Random(3)
    names = [f"name{i}" for i in range(14)]
    values = [f"u{i}@h{i % 3}.example" for i in range(6)] + [f"10.0.{i}.7" for i in range(5)] + [f"+49 30 55{i}4567" for i in range(3)]
    rows = []
    for i in range(900):
        words = made.choices(["the", "of", "day", "open", "week", "house", "road", *(f"w{j}" for j in range(300))], k=9)
        if made.random() < 0.4:
            k = made.randrange(len(values))
            words += [values[k], *made.choices([values[k], names[k]], k=2)] + [values[made.randrange(len(values))]] * (made.random() < 0.2)
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, rows[i][1]) for i in range(0, 900, 7)]
    expected = brute_disclosures(rows)
    marks = Counter(x for told in expected.values() for x in told.values())
    assert marks["generalise"] > 20 and marks["remove"] > 20
    for r in pii_sanitise.spans(documents(rows)).collect():
        text = dict(rows)[r.doc_id]
        assert {(text[s.start : s.end].lower(), s.value) for s in r.term} == set(expected[text].items())


def test_terms_of_any_form_at_all_places(documents):
    long = "x" * 60
    rows = [(i, f"we met at noon and the day was long, 我们今天开会 {i}") for i in range(3000, 3300)]
    far = " we met at noon and the day was long" * 10
    rows += [(900 + i, f"Li, anna77, {long} and 4711: a.b@c.example{far}, Li and anna77; 我们今天王小明开会 {i}") for i in range(3)]
    rows = [*rows, (None, rows[-1][1] + " x"), (None, rows[-1][1] + " x")]
    found = pii_sanitise.spans(documents(rows)).collect()
    row = [r for r in found if r.doc_id == 900][0]
    told = [dict(rows)[900][s.start : s.end] for s in row.term]
    assert sorted(told) == sorted(["Li", "Li", "anna77", "anna77", long, "4711", "天王", "王小", "小明", "明开"])
    clean = pii_sanitise.sanitised(documents(rows)).collect()
    assert len(clean) == len(rows) and sum(r.doc_id is None for r in clean) == 2
    assert not any(x in r.text for r in clean for x in ("王", "明", "Li", "anna77"))
    assert {r.doc_id: r.text for r in clean}[3000] == rows[0][1]


def test_pii_cases(documents):
    assert pii_sanitise.digests(pii_sanitise.spans(documents([]))).count() == 0
    rows = pii_sanitise.digests(pii_sanitise.spans(documents([(1, None), (1, None), (None, "a@b.c")]))).collect()
    assert sorted((str(r.doc_id), r.n_email, r.spans) for r in rows) == [("1", 0, ""), ("1", 0, ""), ("None", 1, "email:0:5")]


def test_pii_runs_without_python(spark, documents):
    plan = pii_sanitise.digests(pii_sanitise.spans(documents([(1, "a@b.c")])))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# ------------------------------------------------------------------ test items


def test_edit_distance_against_plain():
    made = random.Random(1)
    for _ in range(300):
        item = bytes(made.choice(b"abc ") for _ in range(made.randint(1, 40)))
        text = bytes(made.choice(b"abc ") for _ in range(made.randint(0, 80)))
        assert decontaminate.best_match(item, text)[0] == brute.edit_distance_to_passage(item, text)


def test_items_against_plain(spark, documents):
    made = random.Random(7)
    word = lambda: "".join(made.choice("abcdefghij") for _ in range(made.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(12))) for i in range(12)] + [(50, None), (51, "short one"), (52, "")]
    rows = []
    for i in range(120):
        text = list(" ".join(word() for _ in range(40)))
        item = list(made.choice(items[:12])[1].upper())
        for _ in range(made.randint(0, 5)):
            at = made.randrange(len(item))
            item[at : at + 1] = made.choice(["", "z", "qq"])
        if i % 3:
            text[made.randrange(len(text)) : 0] = [" ", *item, " "]
        rows.append((i, "".join(text)))
    rows += [(500, None), (501, ""), (None, items[0][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = set()
    for doc, text in rows:
        for key, item in items:
            item, form = decontaminate.normal_form(item), decontaminate.normal_form(text)
            budget = int(len(item) * decontaminate.EDIT_SHARE)
            if len(item) >= decontaminate.MIN_BYTES and form:
                distance = brute.edit_distance_to_passage(item, form)
                if distance <= budget:
                    expected.add((doc, key, distance))
    docs = documents(rows).withColumn("item_id", F.lit("x"))
    assert len(expected) > 40
    for size in (decontaminate.SLICE_BYTES, 300):  # one slice and several
        found = decontaminate.passages(docs, benchmark, slice_bytes=size).collect()
        assert {(r.doc_id, r.item_id, r.distance) for r in found} == expected and len(found) == len(expected)
    left = {r.doc_id for r in decontaminate.drop_contaminated(docs, benchmark).collect()}
    assert left == {d for d, _ in rows} - {d for d, _, _ in expected}
    assert decontaminate.passages(docs, benchmark.limit(0)).count() == decontaminate.passages(docs.limit(0), benchmark).count() == 0


def test_short_items(spark, documents):
    items = [(1, "short one"), (2, "x = [[1,2],[3,4]]"), (3, "北京大学"), (4, "Who wrote Hamlet?"), (5, "???"), (6, " "), (7, "a1"), (8, "x 1 2"), (None, "f(x)")]
    held = {
        "A Short, ONE indeed": {1}, "take x=[[1, 2], [3,4]].": {2, 8}, "他在北京大学学习": {3}, "asked: who wrotte hamlet": {4}, "what???": {5},
        "see a1.": {7}, "(short one)": {1}, "x 1 2": {8}, "let f( x ) be": {None},
        "a short onerous": set(), "ashort one": set(), "max=[[1,2],[3,4]]": {2}, "max=[[1,2],[3,5]]": set(), "x 1 2 3 4 5": {8}, "a12 ba1": set(), "who wrote hamlets": {4},
        "who wrote it": set(), "北京": set(), "g of x": set(),
    }
    docs = documents(list(enumerate(held)))
    found = decontaminate.passages(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {d: set() for d in range(len(held))}
    for r in found:
        got[r.doc_id].add(r.item_id)
    assert dict(zip(held, got.values())) == held
    assert {(r.item_id, r.distance) for r in found if r.doc_id in (3, 15)} == {(4, 1)}


# ---------------------------------------------------------------------- shards


def test_curve_visits_all_cells_by_steps():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        index = hilbert_shards.curve_index(cells, bits)
        assert sorted(index) == list(range(1 << (bits * dims)))
        path = cells[np.argsort(index)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_shards(spark, documents, given, odd_rows):
    rows = odd_rows + [(1000 + d, t) for d, t in given[:200]] + [(5000 + i, "the same text") for i in range(90)]
    found = hilbert_shards.shard_rows(documents(rows).withColumn("rank", F.lit("x"))).collect()
    assert sorted(str((r.doc_id, r.size, r.text_crc32)) for r in found) == sorted(
        str((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))) for d, t in rows)
    shards = {}
    for r in found:
        shards.setdefault(r.shard, []).append(r)
    assert set(shards) == set(range(24))
    sizes = [len(s) for s in shards.values()]
    assert max(sizes) - min(sizes) <= 1
    order = []
    for s in range(24):
        part = sorted(shards[s], key=lambda r: r.slot)
        assert [r.slot for r in part] == list(range(len(part)))
        order += part
    assert [r.curve for r in order] == sorted(r.curve for r in order)
    same = [i for i, r in enumerate(order) if r.text_crc32 == zlib.crc32(b"the same text")]
    assert same == list(range(same[0], same[0] + 90))
    few = hilbert_shards.shard_rows(documents([(1, "a"), (2, None)])).collect()
    assert sorted(r.slot for r in few) == [0, 0] and hilbert_shards.shard_rows(documents([])).count() == 0


def test_written_shards(spark, documents, tmp_path):
    docs = documents([(i, f"text {i}") for i in range(100)])
    assigned = hilbert_shards.shard_rows(docs, shards=4)
    hilbert_shards.write_shards(docs, assigned, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.doc_id, r.shard) for r in back.collect()} == {(r.doc_id, r.shard) for r in assigned.collect()}


# -------------------------------------------------------------------- pipeline


def test_pipeline_on_a_fixture(spark, tmp_path):
    made = random.Random(11)
    word = lambda: "".join(made.choice("abcdefghijklm") for _ in range(made.randint(2, 8)))
    text = lambda n: "\n".join(" ".join(word() for _ in range(10)) for _ in range(n))
    rows, labels = [], []
    for i in range(300):
        bad = i % 4 == 3
        rows.append((i, " ".join(w + "%%%" for w in text(6).split()) if bad else text(6)))
        labels.append((i, 0 if bad else 1, 0))
    items = [(i, " ".join(word() for _ in range(25))) for i in range(5)]
    rows += [(1000 + i, text(3) + "\n" + items[i][1] + "\n" + text(3)) for i in range(5)]
    base = text(8)
    rows += [(2000 + i, base + f" tail{i}") for i in range(6)]
    rows += [(3000 + i, "A banner that everyone shows.\n" + text(5)) for i in range(15)]
    rows += [(4000, None), (4001, ""), (None, text(4))]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en")).withColumn("source", F.lit(None).cast("string")) \
        .withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, folder)
        assert out.columns == columns
        out.write.parquet(f"{folder}/stage{i}")
        docs = spark.read.parquet(f"{folder}/stage{i}")
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    clean = {i for i in range(300) if i % 4 != 3}
    assert seen["quality"].keys() & set(range(300)) == clean and {None, 1000, 2005, 3014} <= seen["quality"].keys()
    banners = [t for d, t in seen["repeated_lines"].items() if d and 3000 <= d < 3015 and t.startswith("A banner")]
    assert len(banners) == 1
    assert {d for d in seen["near_copies"] if d and 2000 <= d < 2006} == {2000}
    assert not {d for d in seen["test_items"] if d and 1000 <= d < 1005}
    assert clean <= seen["test_items"].keys() and None in seen["test_items"]
    last = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in last} == seen["test_items"].keys()
    assert all(r.decoded_sha256 == hashlib.sha256((seen["test_items"][r.doc_id] or "").encode()).hexdigest() for r in last)


def test_pipeline_stages_tell_rows_of_one_id_apart(spark, documents):
    made = random.Random(12)
    text = lambda n: " ".join("".join(made.choice("abcdefghijklm") for _ in range(made.randint(2, 8))) for _ in range(n))
    item, near = text(25), text(80)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    clean = [(d, text(40)) for d in (None, None, 7, 7, 8)]
    held = [(d, f"{text(20)} {item} {text(20)}") for d in (None, 7, 9)]
    left = decontaminate.drop_contaminated(documents(clean + held), benchmark)
    assert sorted(map(str, ((r.doc_id, r.text) for r in left.collect()))) == sorted(map(str, clean))

    # of id 7 one row is a copy of row 2, the others are like nothing else
    copy = [(7, near + " tail")]
    docs = documents(clean + copy + [(2, near)])
    left = minhash_dedup.drop_near_duplicates(docs)
    got = sorted(str((r.doc_id, r.text)) for r in left.collect())
    assert left.columns == docs.columns
    assert got in [sorted(map(str, clean + one)) for one in (copy, [(2, near)])]
