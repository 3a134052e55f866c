"""Id files as a stateful stream: each article id is passed on when it is first listed, exactly once.

Beside the loads of `intake`, which see a whole batch at a time, this is a plain streaming plan: lines of id files are
parsed, ids seen before are dropped by a state store keyed by article id, and first listings and rejected lines are
appended to file sinks. Sinks keep a log of the batches they hold, so a batch that is replayed after a failure, with its
state restored from the checkpoint, leaves the same rows. The state holds one entry per article ever listed; it lives in
RocksDB on the executors' disks, with copies in the checkpoint, so it need not fit into memory.

Cases: a line with a blank id is passed over, one without a whole number in 64 bits is rejected each time it comes. Ids
listed twice, in one file or in several, arrive once, with one of the files of their first batch. Files must have the
given columns; others end the stream with an error. Repeated listings reach the state as rows, so a much repeated id
costs its task time, not memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from echowire.sources.id_files import parse_ids

ARRIVALS = "articleId bigint, listedAt timestamp, file string"
REJECTED = "rawId string, listedAt timestamp, file string"

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def id_lines(spark: SparkSession, folder: str, columns: Sequence[str] = ("articleId",), files_per_batch: int = 1000) -> DataFrame:
    """A stream of rawId, listedAt (when its file was last changed) and file."""
    lines = (
        spark.readStream.format("csv").schema(", ".join(f"`{c}` string" for c in columns))
        .option("header", True).option("enforceSchema", False).option("maxFilesPerTrigger", files_per_batch).load(folder)
    )
    return lines.select(
        F.col("articleId").alias("rawId"), F.col("_metadata.file_modification_time").alias("listedAt"),
        F.col("_metadata.file_name").alias("file"))


def arrivals(lines: DataFrame) -> DataFrame:
    """First listings of ids; on a stream, of all batches so far."""
    known = parse_ids(lines).where("outcome = 'ok'").select("articleId", "listedAt", "file")
    return known.dropDuplicates(["articleId"])


def rejected(lines: DataFrame) -> DataFrame:
    """Lines that are neither blank nor an id."""
    return parse_ids(lines).where("outcome = 'malformed'").select("rawId", "listedAt", "file")


def arrivals_queries(
    spark: SparkSession, folder: str, out: str, checkpoint: str, columns: Sequence[str] = ("articleId",),
    files_per_batch: int = 1000, continuous: bool = False,
) -> list[StreamingQuery]:
    """Start the streams of arrivals (to `out`/arrivals) and rejected lines; by default they stop at what is there now."""
    spark.conf.set(_PROVIDER, _ROCKS)
    started = []
    for name, made in (("arrivals", arrivals), ("rejected", rejected)):
        rows = made(id_lines(spark, folder, columns, files_per_batch))
        writer = rows.writeStream.format("parquet").outputMode("append")
        writer = writer.option("path", f"{out}/{name}").option("checkpointLocation", f"{checkpoint}/{name}")
        started.append((writer if continuous else writer.trigger(availableNow=True)).start())
    return started


def read_arrivals(spark: SparkSession, out: str) -> DataFrame:
    return _read(spark, f"{out}/arrivals", ARRIVALS)


def read_rejected(spark: SparkSession, out: str) -> DataFrame:
    return _read(spark, f"{out}/rejected", REJECTED)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What finished batches have written; empty if there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
