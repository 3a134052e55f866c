import pathlib

import duckdb
import pytest

import __spark_entry__ as entry

DATA = pathlib.Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0


def test_each_query_has_its_sql():
    assert set(entry._article_queries()) == set(entry._article_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", [
    "ids_invalid", "pairs_load_result", "url_canonical", "content_duplicate_report",
    "content_match_members", "embedding_best_matches", "embedding_from_text", "status_report",
    "status_report_implied",
])
def test_query_equals_sql(spark, database, name):
    from tools.check_queries import rows

    frame = entry.queries()[name](spark, str(DATA))
    relation = database.sql(entry.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    assert rows(frame.columns, frame.collect()) == rows(relation.columns, relation.fetchall())
