"""The stateful stream: first listings once, over restarts, replays and new files."""

import pathlib

import pytest
from pyspark.errors import StreamingQueryException

from echowire.streaming.arrivals import arrivals_queries, read_arrivals, read_rejected


@pytest.fixture
def place(spark, tmp_path):
    (tmp_path / "in").mkdir()

    class Place:
        folder, out, state = tmp_path / "in", str(tmp_path / "out"), tmp_path / "state"

        @staticmethod
        def run(**settings):
            for query in arrivals_queries(spark, str(Place.folder), Place.out, str(Place.state), **settings):
                assert query.awaitTermination(120)
                if query.exception():
                    raise query.exception()

        @staticmethod
        def ids():
            return sorted(r.articleId for r in read_arrivals(spark, Place.out).collect())

        @staticmethod
        def lines():
            return sorted(r.rawId for r in read_rejected(spark, Place.out).collect())

    return Place


def test_each_id_arrives_once(spark, place):
    assert place.ids() == place.lines() == []
    (place.folder / "a.csv").write_text("articleId,note\n1,x\n 2 ,y\n1,z\nbad,\n,\n")
    (place.folder / "b.csv").write_text("articleId,note\n2,x\n+3,y\n9999999999999999999,\n")
    place.run(columns=("articleId", "note"), files_per_batch=1)
    assert place.ids() == [1, 2, 3] and place.lines() == ["9999999999999999999", "bad"]
    place.run(columns=("articleId", "note"))  # a restart without new files
    assert place.ids() == [1, 2, 3]
    (place.folder / "c.csv").write_text("articleId,note\n3,x\n4,y\nbad,\n")
    place.run(columns=("articleId", "note"))
    assert place.ids() == [1, 2, 3, 4] and place.lines() == ["9999999999999999999", "bad", "bad"]
    row = read_arrivals(spark, place.out).where("articleId = 4").first()
    assert row.file == "c.csv" and row.listedAt is not None


def test_a_replayed_batch_leaves_the_same_rows(spark, place):
    (place.folder / "a.csv").write_text("articleId\n" + "".join(f"{i}\n" for i in range(50)))
    place.run()
    (place.folder / "b.csv").write_text("articleId\n" + "".join(f"{i}\n" for i in range(25, 75)) + "x\n")
    place.run()
    before = sorted(map(tuple, read_arrivals(spark, place.out).collect()))
    # as if the driver had been lost after the sink was written and before the batch was noted as done
    for name in ("arrivals", "rejected"):
        commits = sorted(p for p in pathlib.Path(place.state, name, "commits").iterdir() if p.name.isdigit())
        last = max(commits, key=lambda p: int(p.name))
        last.with_name(f".{last.name}.crc").unlink(missing_ok=True)
        last.unlink()
    place.run()
    assert sorted(map(tuple, read_arrivals(spark, place.out).collect())) == before
    assert place.ids() == list(range(75)) and place.lines() == ["x"]


def test_other_columns_are_an_error(spark, place):
    (place.folder / "a.csv").write_text("note,articleId\na,1\n")
    with pytest.raises(StreamingQueryException):
        place.run(columns=("articleId", "note"))
    assert place.ids() == []
