import pytest

from echowire.sources.id_files import (
    distinct_ids, id_file_quality, known_ids, parse_ids, read_id_file, rejected_lines, unknown_ids,
)


@pytest.fixture
def id_file(tmp_path):
    path = tmp_path / "ids.csv"
    lines = ["1,a", " 2 ,b", "+3,c", "2,d", ",e", "x,f", "12.0,g", "999999,h", "1_0,i", "1__0,j",
             "99999999999999999999,k", "-5,l", '"3","quoted, ""m"""', "", "　7　,n"]
    path.write_bytes("﻿ articleId , other \n".encode() + "\n".join(lines).encode())
    return str(path)


def _articles(spark):
    return spark.createDataFrame([(i, None) for i in (1, 2, 3, 7, 10, 500)], "id bigint, url string")


def test_ids_of_a_file(spark, id_file):
    lines = read_id_file(spark, id_file)
    ids = distinct_ids(lines)
    assert sorted(r[0] for r in ids.collect()) == [-5, 1, 2, 3, 7, 10, 999999]
    assert sorted(r[0] for r in known_ids(ids, _articles(spark)).collect()) == [1, 2, 3, 7, 10]
    assert sorted(r[0] for r in unknown_ids(ids, _articles(spark)).collect()) == [-5, 999999]
    assert sorted(r[0] for r in rejected_lines(lines).collect()) == [
        "12.0", "1__0", "99999999999999999999", "x"
    ]


def test_quality(spark, id_file):
    row = id_file_quality(read_id_file(spark, id_file), _articles(spark)).first()
    assert row.asDict() == {
        "line_count": 14, "blank": 1, "malformed": 4, "repeated": 2, "known": 5, "unknown": 2,
        "valid_format": False,
    }


def test_short_lines_count_as_blank(spark, tmp_path):
    path = tmp_path / "short.csv"
    path.write_text("other,articleId\na,1\nb\n")
    outcomes = [r.outcome for r in parse_ids(read_id_file(spark, str(path))).collect()]
    assert sorted(outcomes) == ["blank", "ok"]


def test_missing_column(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("id\n1\n")
    with pytest.raises(ValueError, match="articleId"):
        read_id_file(spark, str(path))


def test_empty_file_of_ids(spark, tmp_path):
    path = tmp_path / "none.csv"
    path.write_text("articleId\n")
    lines = read_id_file(spark, str(path))
    assert distinct_ids(lines).count() == 0
    row = id_file_quality(lines, _articles(spark)).first()
    assert row.line_count == 0 and row.valid_format
