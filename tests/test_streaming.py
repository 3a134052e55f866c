import shutil

import pytest

from echowire.operators import implied
from echowire.sources import tables
from echowire.sources.intake_log import claim_load, read_log, roster, write_load
from echowire.streaming.intake import intake_query, read_id_files, read_rejects


def _rows(spark, log):
    return sorted((r.articleId, r.role, r.load) for r in read_log(spark, log).collect())


def _new(spark, log):
    return sorted((r.load, r.articleId) for r in read_log(spark, log).where("role = 'new'").collect())


def _rejects(spark, log):
    return sorted((r.load, r.rawId, r.reason) for r in read_rejects(spark, log).collect())


@pytest.fixture
def place(spark, tmp_path):
    """A folder of id files with its log, and a function that runs a stream over it."""
    (tmp_path / "in").mkdir()
    approvals = [(1, 10, None, "a", True), (2, 11, None, "b", True)]

    def articles():
        return spark.createDataFrame([(i, None) for i in (1, 2, 3, 10)], tables.ARTICLES)

    def approved():
        return spark.createDataFrame(approvals, tables.APPROVED)

    class Place:
        folder, log, given = tmp_path / "in", str(tmp_path / "log"), approvals

        @staticmethod
        def run(state="state", **settings):
            query = intake_query(
                spark, str(tmp_path / "in"), Place.log, str(tmp_path / state), articles, approved, **settings)
            assert query.awaitTermination(120)
            if query.exception():
                raise query.exception()

    return Place


def test_id_files_become_loads(spark, place):
    (place.folder / "first.csv").write_text("note,articleId\na,1\nb, 2 \nc,x\nd,77\ne,1\n")
    place.run()
    assert _rows(spark, place.log) == [(1, "new", 0), (2, "new", 0), (10, "approved", 0), (11, "approved", 0)]
    assert _rejects(spark, place.log) == [(0, "77", "unknown"), (0, "x", "malformed")]

    place.given.append((3, 12, None, "c", True))
    (place.folder / "second.csv").write_text("articleId,note\n2,a\n3,b\n")
    place.run()
    assert _rows(spark, place.log)[-1] == (12, "approved", 1)
    stats = implied.pair_stats(roster(read_log(spark, place.log))).first()
    assert (stats.total_pairs, stats.unique_new_articles, stats.unique_approved_articles) == (8, 3, 3)

    before = _rows(spark, place.log)
    place.run()  # nothing new
    assert _rows(spark, place.log) == before


def test_columns_are_found_by_header(spark, place):
    (place.folder / "a.csv").write_text("note,articleId\n2,1\n3,1\n")
    (place.folder / "b.csv").write_text("﻿ articleId ,note\n2,1\n", encoding="utf-8")
    (place.folder / "c.csv").write_text('"x, y", articleId\n"5, 6",3\n')
    place.run()
    assert _new(spark, place.log) == [(0, 1), (0, 2), (0, 3)]


@pytest.mark.parametrize("text", ["id,note\n1,2\n", "\n1\n"])
def test_a_file_without_the_column_fails(spark, place, text):
    (place.folder / "empty.csv").write_text("")  # holds nothing and is passed over
    (place.folder / "a.csv").write_text(text)
    with pytest.raises(Exception, match="articleId|header"):
        place.run()
    assert _new(spark, place.log) == []


def test_a_second_checkpoint_keeps_all_loads(spark, place):
    (place.folder / "a.csv").write_text("articleId\n2\n")
    place.run("one")
    (place.folder / "b.csv").write_text("articleId\n3\n")
    place.run("two")  # a new stream reads both files anew
    assert _new(spark, place.log) == [(0, 2), (1, 2), (1, 3)]
    ids = spark.createDataFrame([(1,)], "articleId bigint")
    with pytest.raises(ValueError, match="another writer"):
        write_load(spark, place.log, ids, tables.approved_ids(ids), 0)
    write_load(spark, place.log, ids, ids, 7)
    write_load(spark, place.log, ids, ids, 7)  # its own load may be repeated
    assert _new(spark, place.log) == [(0, 2), (1, 2), (1, 3), (7, 1)]
    (place.folder / "c.csv").write_text("articleId\n1\n")
    place.run("one")  # sees b and c
    assert _new(spark, place.log)[-2:] == [(8, 1), (8, 3)]


def test_a_replayed_batch_replaces_its_own_load(spark, place, tmp_path):
    (place.folder / "a.csv").write_text("articleId\n2\nbad\n")
    place.run()
    before = _rows(spark, place.log)
    shutil.rmtree(tmp_path / "state" / "commits")  # as if the driver died before the commit
    place.run()
    assert _rows(spark, place.log) == before and _rejects(spark, place.log) == [(0, "bad", "malformed")]


def test_claims_are_exclusive_and_lasting(spark, tmp_path):
    log = str(tmp_path / "log")
    assert [claim_load(spark, log, "a", 0), claim_load(spark, log, "b", 0), claim_load(spark, log, "a", 1)] == [0, 1, 2]
    assert [claim_load(spark, log, "a", 1), claim_load(spark, log, "b", 0)] == [2, 1]


def test_headers_of_large_lists(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"{i}.csv").write_text(f"articleId,n\n{i},x\n" if i % 2 else f"n,articleId\nx,{i}\n")
    rows = read_id_files(spark, [str(tmp_path / f"{i}.csv") for i in range(30)])
    assert sorted(int(r.rawId) for r in rows.collect()) == list(range(30))
