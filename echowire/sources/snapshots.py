"""Rating snapshots bucketed by their pair, so that the next snapshot is made without shuffling the one before.

A snapshot is cut into buckets by a hash of the two ids when it is first written. What is joined with it by the pair, new pairs or
new scores, is shuffled to these buckets, and each task reads one bucket, adds to it and writes it again.

A bucketed snapshot is a table of the session's catalog over files at a path; `read_bucketed` enters it into the catalog
of another session. The number of buckets belongs to the snapshot; choose it so that a bucket fits into a task, some
hundred MB each, as all later snapshots keep it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from echowire.session import path_exists
from echowire.sources.tables import PAIR, RATINGS

BUCKETS = 64


def _table_name(path: str) -> str:
    return f"ratings_{hashlib.sha256(path.rstrip('/').encode()).hexdigest()[:24]}"


def write_bucketed(ratings: DataFrame, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Write a new bucketed snapshot and read it back; an existing path is an error.

    Rows whose partitions are already those buckets are written where they are, any others once per bucket and task:
    `bucketed` rows first if there are many.
    """
    spark = ratings.sparkSession
    if path_exists(spark, path):
        raise ValueError(f"{path} exists")
    rows = ratings.select(*(f.name for f in RATINGS.fields))
    rows.write.format("parquet").option("path", path).bucketBy(buckets, *PAIR).sortBy(*PAIR).saveAsTable(_table_name(path))
    return spark.table(_table_name(path))


def bucketed(ratings: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows shuffled to the buckets of a snapshot, for its first version."""
    return ratings.repartition(buckets, *PAIR)


def read_bucketed(spark: SparkSession, path: str, buckets: int = BUCKETS) -> DataFrame:
    """A bucketed snapshot that this or another session has written with so many buckets."""
    if not path_exists(spark, path):
        raise ValueError(f"{path} does not exist")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RATINGS.fields)
    keys = ", ".join(PAIR)
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_table_name(path)} ({columns}) USING parquet "
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return spark.table(_table_name(path))
